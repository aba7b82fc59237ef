"""The shared warehouse: lineage columns, schema contract and partitioned writes."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.sources.contracts import fitted

PARTITION = "partition_num"


def tag_site(df: DataFrame, site: str, partition: int) -> DataFrame:
    return df.withColumns({"site": F.lit(site), PARTITION: F.lit(partition)})


def union_sites(parts: list[DataFrame]) -> DataFrame:
    """All sites as one table; every part must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the contract in order and type; unknown or missing columns and lost values are an error."""
    return fitted(df, schema)


def write_site_partition(df: DataFrame, path: str, partition: int | None = None, contract: T.StructType | None = None) -> None:
    """Replace a site's partition and leave all others alone.

    With a ``contract`` (without the partition column) the rows are made to fit it first, or nothing is written.

    With ``partition`` that one is replaced even if ``df`` is empty, so a site that lost its last rows is emptied;
    without it, the partitions present in ``df``.
    """
    if contract is not None:
        with_partition = T.StructType([*contract.fields, T.StructField(PARTITION, df.schema[PARTITION].dataType)])
        df = fitted(df, with_partition, path)
    if partition is not None:
        other = df.filter(~F.col(PARTITION).eqNullSafe(partition)).limit(1).count()
        if other:
            raise ValueError(f"rows of another partition than {partition}")
        df.drop(PARTITION).write.mode("overwrite").parquet(f"{path}/{PARTITION}={partition}")
        return
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def publish(df: DataFrame, database: str, table: str, contract: T.StructType | None = None) -> None:
    """Build a new version of a table, made to fit its ``contract`` if there is one, then point the name at it.

    The name is a view, replaced in one step: readers see the old rows or the new ones, never a gap, and a job that dies
    before the step leaves the old version in place. Versions no longer shown are dropped afterwards, those of
    jobs that died too.
    """
    spark = df.sparkSession
    if contract is not None:
        df = fitted(df, contract, f"{database}.{table}")
    version = f"{table}_v{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(f"{database}.{version}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{version}")
    old = re.compile(re.escape(table) + "_v[0-9a-f]{32}")
    for t in spark.catalog.listTables(database):
        if old.fullmatch(t.name) and t.name != version:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{t.name}")


def read_warehouse(spark: SparkSession, path: str, partition: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if partition is None else df.filter(F.col(PARTITION) == partition)
