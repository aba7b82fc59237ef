"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a local session without one a folder of our own, which goes with the process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="wardmill-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        folder = f"file://{made}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: the plan ends here and its size is known."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Published:
    """Tables that an owner builds once and all its readers share; they go with their owner.

    A new owner over the same place builds anew, so a table is never served for other data than its own.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.paths:
            path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
            build().write.parquet(path)
            self.paths[name] = path
        return self.spark.read.parquet(self.paths[name])

    def refresh(self) -> None:
        """Build anew at the next use."""
        self.paths.clear()
