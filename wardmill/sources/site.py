"""Readers for one site's source tables and the date filters of the extracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.functions.dates import trailing_months_start
from wardmill.sources.staging import Published

#: Tables too large to be read in one slice.
LARGE = ("obs", "encounter", "orders")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds files to read there."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as x:
        if x.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def adapted(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """``df`` with the ``wanted`` columns (name to type): an absent one is null, one of another type is cast."""
    have = {c.lower(): c for c in df.columns}
    return df.withColumns({have.get(c.lower(), c): (F.col(have[c.lower()]) if c.lower() in have else F.lit(None)).cast(t) for c, t in wanted.items()})


class Site:
    """What the jobs ask of a site besides its tables."""

    spark: SparkSession
    _shared: Published | None = None

    def published(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that all jobs of this site object share, built at its first use."""
        if self._shared is None:
            self._shared = Published(self.spark)
        return self._shared.get(name, build)

    def refresh(self) -> None:
        """Forget the shared tables, so that the next job reads the source again."""
        if self._shared is not None:
            self._shared.refresh()

    def columns(self, table: str) -> dict[str, T.DataType]:
        """Names and types of the table's columns."""
        return {f.name: f.dataType for f in self.read(table).schema.fields}

    def with_columns(self, table: str, wanted: dict[str, str]) -> DataFrame:
        """The table with the ``wanted`` columns (name to type): one that the site lacks is null, of the same type."""
        return adapted(self.read(table), wanted)


class ParquetSite(Site):
    """A site whose tables are Parquet files under one folder."""

    def __init__(self, spark: SparkSession, name: str, partition: int, folder: str):
        self.spark, self.name, self.partition, self.folder = spark, name, partition, folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))


class JdbcSite(Site):
    """A site database read over JDBC in parallel slices of a numeric key.

    ``bounds`` gives (column, lowest, highest, slices) per large table, and must
    for LARGE; another table without bounds is read in one slice.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        partition: int,
        url: str,
        properties: dict[str, str],
        bounds: dict[str, tuple[str, int, int, int]] | None = None,
    ):
        self.spark, self.name, self.partition, self.url = spark, name, partition, url
        self.properties, self.bounds = properties, bounds or {}

    def options(self, table: str) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": table, "pushDownPredicate": "true", **self.properties}
        if table in self.bounds:
            column, low, high, n = self.bounds[table]
            opts |= {
                "partitionColumn": column,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(n),
            }
        elif table in LARGE:
            raise ValueError(f"{table} needs bounds: it is too large for one slice")
        return opts

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(table)).load()

    def exists(self, table: str) -> bool:
        q = f"(SELECT count(*) AS n FROM information_schema.tables WHERE table_name = '{table}') AS t"
        return self.spark.read.format("jdbc").options(**{**self.options(table), "dbtable": q}).load().first()[0] > 0


class CatalogSite(Site):
    """A site whose tables live in one schema of the session catalog."""

    def __init__(self, spark: SparkSession, name: str, partition: int, database: str):
        self.spark, self.name, self.partition, self.database = spark, name, partition, database

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")


def read_site(site, table: str) -> DataFrame:
    return site.read(table)


def extract_if(site, table: str, job: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """Run ``job`` only if the site has ``table``; otherwise an empty frame of the job's schema."""
    return job() if site.exists(table) else site.spark.createDataFrame([], schema)


def date_window(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows from ``start`` to ``end``, both whole days and both optional.

    The column itself is compared, so the filter reaches the Parquet scan.
    """
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(column) < (F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")))
    return df


def trailing_months(df: DataFrame, column: str, as_of, months: int = 13) -> DataFrame:
    return df.filter(F.col(column) >= trailing_months_start(as_of, months).cast("timestamp_ntz"))
