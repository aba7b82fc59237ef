"""Reference tables: literal rows or delimited files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column contract of the medication category list; the list itself is site data and is read from a file.
DRUG_CATEGORIES = (
    "product_code string, product_name string, category_name string, subcategory string, "
    "on_global_form string, on_HA_form string"
)


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals inside the plan; no data leaves the driver for it."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)]) for r in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def reference_file(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A delimited reference file, read with its schema and never with inference."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, mode="FAILFAST")
