"""Entity-level incremental refresh: replace all rows of the patients that changed.

Deltas are at the grain of a patient, so applying one twice gives the same
table as applying it once, and a late change is picked up by the inclusive
range of the next run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.sources.site import path_exists
from wardmill.sources.warehouse import PARTITION, write_site_partition

LOG_SCHEMA = (
    "table_name string, partition_num int, starting_watermark timestamp_ntz, "
    "ending_watermark timestamp_ntz, completed_datetime timestamp_ntz"
)


def patient_last_update(feed: DataFrame, partition: int) -> DataFrame:
    """The change feed with warehouse patient keys."""
    return feed.select(
        F.concat(F.lit(f"{partition}-"), F.col("patient_id").cast("string")).alias("patient_id"),
        "last_updated",
        "deleted",
        F.lit(partition).alias(PARTITION),
    )


def new_watermark(changes: DataFrame, partition: int):
    """Latest change of the partition; None when there is none."""
    return changes.filter(F.col(PARTITION) == partition).agg(F.max("last_updated")).first()[0]


def prev_watermark(log: DataFrame, table: str, partition: int):
    mine = log.filter((F.col("table_name") == table) & (F.col(PARTITION) == partition))
    return mine.agg(F.max("ending_watermark")).first()[0]


def changed(changes: DataFrame, lo, hi) -> DataFrame:
    """Patients changed in [lo, hi], both ends included."""
    ts = F.col("last_updated")
    ntz = lambda v: F.lit(v).cast("timestamp_ntz")
    return changes.filter((ts >= ntz(lo)) & (ts <= ntz(hi))).select("patient_id").distinct()


def drop_changed(df: DataFrame, changes: DataFrame, lo, hi, key: str = "patient_id") -> DataFrame:
    return df.join(changed(changes, lo, hi).withColumnRenamed("patient_id", key), key, "left_anti")


def delta_extract(df: DataFrame, changes: DataFrame, lo, hi, key: str = "patient_id") -> DataFrame:
    """Rows of changed patients; everything when there is no previous watermark."""
    if lo is None:
        return df
    return df.join(changed(changes, lo, hi).withColumnRenamed("patient_id", key), key, "left_semi")


def refreshed(base: DataFrame, fresh: DataFrame, changes: DataFrame, lo, hi, key: str = "patient_id") -> DataFrame:
    """The table after the refresh: untouched patients from ``base``, changed ones from ``fresh``."""
    if lo is None:
        return fresh
    return drop_changed(base, changes, lo, hi, key).unionByName(delta_extract(fresh, changes, lo, hi, key))


def log_watermark(spark: SparkSession, path: str, table: str, partition: int, lo, hi, completed) -> None:
    row = spark.createDataFrame([(table, partition, lo, hi, completed)], LOG_SCHEMA)
    row.write.mode("append").parquet(path)


def incremental_refresh(
    spark: SparkSession, table_path: str, log_path: str, table: str, partition: int, fresh: DataFrame,
    changes: DataFrame, completed, staging: str,
) -> None:
    """Refresh one site's partition of a warehouse table and record the watermark.

    The new partition is written beside the table first, to ``staging`` on
    shared storage: a job must not overwrite the files it is still reading.
    """
    log = read_log(spark, log_path)
    lo, hi = prev_watermark(log, table, partition), new_watermark(changes, partition)
    if hi is None:
        return
    base = spark.read.parquet(table_path).filter(F.col(PARTITION) == partition) if lo is not None else fresh
    refreshed(base, fresh, changes, lo, hi).write.mode("overwrite").parquet(staging)
    write_site_partition(spark.read.parquet(staging), table_path, partition)
    log_watermark(spark, log_path, table, partition, lo, hi, completed)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    return spark.createDataFrame([], LOG_SCHEMA)


def follow_changes(
    spark: SparkSession, feed_path: str, feed_schema: str, apply, checkpoint: str, trigger_once: bool = True
):
    """Streaming form: each batch of the change feed is applied by ``apply(changes, batch_id)``.

    A replayed batch is harmless because ``apply`` replaces whole patients.
    """
    stream = spark.readStream.schema(feed_schema).parquet(feed_path)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        latest = batch.groupBy("patient_id").agg(
            F.max("last_updated").alias("last_updated"), F.max_by("deleted", "last_updated").alias("deleted")
        )
        apply(latest, batch_id)

    w = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if trigger_once else w).start()
