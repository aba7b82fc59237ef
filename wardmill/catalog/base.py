"""Registry of the queries over the driver tables.

Each entry names the survey items it shows, builds a DataFrame from the Parquet
tables of one scale folder, and (where SQL can say it) carries the same query
as SQL for an independent engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


# The driver's table contracts, declared so that no read has to infer a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


class Tables:
    """``t.orders`` reads orders.parquet of the folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def query(name: str, covers: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(lambda spark, folder: fn(Tables(spark, folder)), sql, tuple(covers.split()))
        return fn

    return register
