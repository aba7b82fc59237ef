"""Exact deduplication by counting quotient filters.

Each partition builds a counting quotient filter of its documents' 64-bit fingerprints. A filter is cut by the leading
bits of the quotient into blocks; equal blocks of all partitions meet in one task and merge without loss, as their
remainders are sorted. Fingerprints counted more than once are routed to a comparison of the normalised bytes.

A null text counts as empty, and empty texts are equal to each other. Rows with the same doc_id are told apart by
``row_id`` (see common.with_row_ids); of fully equal rows one stays. Null ids sort last. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import SPACE, free_names, with_row_ids, written

#: Bits of a quotient inside its block; the bits before them name the block, the bits after are the remainder.
QUOTIENT_BITS = 16
#: Fingerprints a merged block should hold on average.
BLOCK_ROWS = 1 << 19


def build_filter(fingerprints: np.ndarray, remainder_bits: int) -> bytes:
    """One block: occupied and run-end bits, the sorted remainders of the runs, and the counters above one."""
    values, counts = np.unique(fingerprints, return_counts=True)
    r = np.uint64(remainder_bits)
    quotient = (values >> r).astype(np.int64) & ((1 << QUOTIENT_BITS) - 1)
    occupied = np.zeros(1 << QUOTIENT_BITS, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True) if len(values) else np.zeros(0, bool)
    width = (remainder_bits + 7) // 8
    remainder = (values & ((np.uint64(1) << r) - np.uint64(1))).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    several = counts > 1
    parts = [
        np.flatnonzero(occupied).astype("<u2").tobytes() if occupied.sum() < 1 << 12 else np.packbits(occupied).tobytes(),
        np.packbits(run_end).tobytes(),
        np.packbits(several).tobytes(),
        counts[several].astype("<u8").tobytes(),
        np.ascontiguousarray(remainder).tobytes(),
    ]
    return struct.pack("<6I", len(values), *map(len, parts)) + b"".join(parts)


def read_filter(block: int, blob: bytes, remainder_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a block and their counts."""
    n, *sizes = struct.unpack_from("<6I", blob)
    ends = np.cumsum([24, *sizes])
    raw = [blob[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    if sizes[0] == 1 << (QUOTIENT_BITS - 3):
        quotients = np.flatnonzero(np.unpackbits(np.frombuffer(raw[0], np.uint8)))
    else:
        quotients = np.frombuffer(raw[0], "<u2").astype(np.int64)
    run_end = np.unpackbits(np.frombuffer(raw[1], np.uint8), count=n).astype(bool)
    run = np.cumsum(run_end) - run_end
    counts = np.ones(n, np.uint64)
    counts[np.unpackbits(np.frombuffer(raw[2], np.uint8), count=n).astype(bool)] = np.frombuffer(raw[3], "<u8")
    width = (remainder_bits + 7) // 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw[4], np.uint8).reshape(n, width)
    remainder = wide.view("<u8").reshape(-1).astype(np.uint64)
    head = (np.uint64(block) << np.uint64(QUOTIENT_BITS)) | quotients[run].astype(np.uint64)
    return (head << np.uint64(remainder_bits)) | remainder, counts


def merge_filters(block: int, blobs: list[bytes], remainder_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The union of filters: remainders of a quotient stay sorted, counters of equal ones add up."""
    read = [read_filter(block, b, remainder_bits) for b in blobs]
    values = np.concatenate([v for v, _ in read])
    counts = np.concatenate([c for _, c in read])
    order = np.argsort(values, kind="stable")  # runs of sorted input: the stable sort merges them
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(values) else counts


def repeated_fingerprints(digests: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (column fp) that the merged filters count more than once."""
    block_bits = max(1, int(np.ceil(np.log2(max(rows, 1) / BLOCK_ROWS)))) if rows > BLOCK_ROWS else 1
    remainder_bits = 64 - block_bits - QUOTIENT_BITS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def blocks():
            values = np.sort(np.concatenate(held))
            block = (values >> np.uint64(64 - block_bits)).astype(np.int64)
            names, starts = np.unique(block, return_index=True)
            parts = np.split(values, starts[1:])
            return pa.record_batch(
                [pa.array(names, pa.int64()), pa.array([build_filter(p, remainder_bits) for p in parts], pa.binary())],
                names=["block", "filter"],
            )

        for b in batches:
            held.append(b.column(0).to_numpy().view(np.uint64))
            n += len(held[-1])
            if n >= 4 * BLOCK_ROWS:
                yield blocks()
                held, n = [], 0
        if n:
            yield blocks()

    def merge(pdf):
        if not len(pdf):
            return pdf.assign(fp=[])[["fp"]]
        values, counts = merge_filters(int(pdf["block"].iloc[0]), list(pdf["filter"]), remainder_bits)
        return type(pdf)({"fp": values[counts > 1].view(np.int64)})

    filters = digests.select("fp").mapInArrow(build, "block long, filter binary")
    return filters.groupBy("block").applyInPandas(merge, "fp long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, keep_row, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical after replacing each run of ASCII white space by one space.
    """
    rows, _ = with_row_ids(docs.select("doc_id", "text"))
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    hashed = rows.select("row_id", "doc_id", normal.alias("normal"))
    hashed = hashed.withColumn("fp", F.xxhash64("normal"))
    digests = written(hashed.select("row_id", "doc_id", "fp", F.sha2("normal", 256).alias("text_sha256")), "digests")
    repeated = written(repeated_fingerprints(digests, digests.count()), "fingerprints")
    # byte verification: the whole normalised text is the key, and equal texts of one task combine before the shuffle
    verified = (
        hashed.join(repeated, "fp", "left_semi")
        .groupBy("fp", "normal")
        .agg(F.min("row_id").alias("keep_row"), F.min(F.struct("row_id", "doc_id"))["doc_id"].alias("keep_id"), F.count("*").alias("group_size"))
        .select("fp", F.sha2("normal", 256).alias("text_sha256"), "keep_row", "keep_id", "group_size")
    )
    return digests.join(verified, ["fp", "text_sha256"], "left").select(
        "row_id",
        "doc_id",
        F.coalesce("keep_row", "row_id").alias("keep_row"),
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.coalesce("keep_row", "row_id") == F.col("row_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that equal an earlier one; columns as before."""
    (own,) = free_names(docs, "row_id")
    rows, _ = with_row_ids(docs, own)
    found = exact_groups(rows.select(F.col(own).alias("doc_id"), "text"))
    gone = written(found.where(~F.col("kept")).select(F.col("row_id").alias(own)), "copies")
    return rows.join(gone, own, "left_anti").select(*docs.columns)
