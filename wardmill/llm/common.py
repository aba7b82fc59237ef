"""What the training-data operators share: reading, tables written to the shared folder, row ids."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts, as a Java regular expression.
SPACE = r"[\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; in a local session without one a folder of our own."""
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


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until ``df`` has no column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here and Spark knows the size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows written in the given order, with their number in it from 1 on; equal rows are numbered arbitrarily.

    A range exchange numbers its partitions in order, so a row's number is its place in its partition and the rows of
    the partitions before; the driver gets one number per partition.
    """
    kept = written(df.orderBy(*order).withColumn(name, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(name, 33)
    counts = sorted((r["part"], r["n"]) for r in kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for p, n in counts:
        before.append((p, total + 1))
        total += n
    bases = df.sparkSession.createDataFrame(before, "_wm_part long, _wm_base long")
    placed = kept.join(F.broadcast(bases), part == F.col("_wm_part"))
    return placed.withColumn(name, F.col(name).bitwiseAND((1 << 33) - 1) + F.col("_wm_base")).drop("_wm_part", "_wm_base")


def with_row_ids(docs: DataFrame, name: str = "row_id") -> tuple[DataFrame, bool]:
    """The columns of docs and ``name``, unique and in the order of doc_id (null last); docs has no such column.

    Ids that are unique and not null serve as they are. Otherwise the rows are sorted by id and text and numbered,
    and written so that the numbers stay; the second value then is True.
    """
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    odd = ids.unionByName(docs.select("doc_id").where("doc_id IS NULL")).limit(1).count()
    if not odd:
        return docs.withColumn(name, F.col("doc_id")), False
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in rest)]
    # a range exchange numbers its partitions in order, so the generated ids follow the sort
    return written(docs.orderBy(*order).withColumn(name, F.monotonically_increasing_id()), "numbered"), True


#: Bytes of text that a worker takes at once.
SLICE = 4 << 20


def in_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a column have SLICE bytes at most, or are one text: a batch has 10,000 rows, however long."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes.astype(np.int64)), 0
        while first < b.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + SLICE, "right")))
            yield b.slice(first, last - first)
            first = last


def give_back() -> None:
    """Freed memory of this process goes to the system, where the allocators let it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow, after which the worker holds no freed memory: workers live on, and their executor's limit counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run
