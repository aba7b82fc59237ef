"""Target-distribution importance resampling over hashed word features.

A document's features are its runs of 1 to ``longest`` consecutive words, hashed into buckets. A bucket's gain is the
scaled logarithm of its smoothed share in the target texts over its share in all documents; a document's weight is the
sum of its features' gains. Gumbel noise drawn from its id makes the highest scores a sample without replacement in
proportion to the weights' exponentials.

Features are found for many texts at once: the texts are joined with a separator between them, one pass of a regular
expression finds all words, searching the words' places in the documents' offsets says whose they are, runs that would
cross two documents are masked, and the buckets are counted with bincount. A slice of texts joined at once has a bound
in bytes; a longer single text is a slice of its own.

A null or empty text has no features and weight 0. A null doc_id draws its noise as the text ``null`` and comes after
all others in a tie. Rows are scored one by one, so repeated ids or rows each give a row; equal scores of equal ids are
told apart arbitrarily. Other columns are ignored, and kept by ``drawn``. Without documents the result is empty; without target texts
every bucket's target share is the smoothed one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import free_names, numbered, with_row_ids, written

BUCKETS, LONGEST, LEAST_WORDS, SHARE, SEED = 10_000, 1, 20, 10, "2024"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Between two texts: in no word.
SEPARATOR = b"\x00"
#: Bytes of text joined at once.
SLICE = 1 << 20


def occurrences(texts: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every feature, ordered by text."""
    joined = SEPARATOR.join(texts).lower()  # of bytes: A-Z only
    starts, words = [], []
    for m in WORD.finditer(joined):
        starts.append(m.start())
        words.append(m[0])
    ends = np.cumsum(np.array([len(t) + len(SEPARATOR) for t in texts], np.int64))
    own = np.searchsorted(ends, np.array(starts, np.int64), "right")
    owners, found = [], []
    for k in range(1, longest + 1):
        runs = words if k == 1 else [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        first, last = own[: len(runs)], own[k - 1 :]
        inside = first == last
        codes = np.fromiter(map(zlib.crc32, runs), np.uint32, len(runs)) % np.uint32(buckets)
        owners.append(first[inside])
        found.append(codes[inside])
    own, codes = np.concatenate(owners), np.concatenate(found)
    if longest > 1:
        order = np.argsort(own, kind="stable")
        own, codes = own[order], codes[order]
    return own, codes


def slices(values: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts as bytes) for runs of texts of at most about SLICE bytes."""
    held, size, first = [], 0, 0
    for i, v in enumerate(values):
        held.append(v.as_py() or b"")
        size += len(held[-1])
        if size >= SLICE:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def featured(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``rows`` but its text, with n_features and features (buckets, little-endian unsigned 16- or 32-bit)."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept, F.lit(0).cast("long").alias("n_features"), F.lit(b"").alias("features")).schema

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in slices(b.column(len(kept)).cast(pa.binary())):
                own, codes = occurrences(texts, longest, buckets)
                counts = np.bincount(own, minlength=len(texts))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * kind.itemsize
                data = codes.astype(kind).tobytes()
                blobs = [data[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                part = [b.column(k).slice(first, len(texts)) for k in range(len(kept))]
                yield pa.record_batch([*part, pa.array(counts.astype(np.int64)), pa.array(blobs, pa.binary())], names=[*kept, "n_features", "features"])

    return rows.select(*kept, "text").mapInArrow(work, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket; the driver gets one number per bucket."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for value in b.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer() or b"", kind), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for r in features.select("features").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The scaled log ratio of smoothed shares, floored."""
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """The columns of ``features`` with the weight in place of the features."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")
    kept = [c for c in features.columns if c != "features"]
    schema = features.select(*kept, F.lit(0).cast("long").alias("weight")).schema

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = [int(gain[np.frombuffer(v.as_buffer() or b"", kind)].sum()) for v in b.column(len(kept))]
            yield pa.record_batch([*b.columns[:-1], pa.array(total, pa.int64())], names=[*kept, "weight"])

    return features.select(*kept, "features").mapInArrow(work, schema)


def ranked(rows: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: int = SHARE, seed: str = SEED) -> DataFrame:
    """The columns of ``rows`` (doc_id, text and more) but the text, with n_features, weight, score and rank.

    Of the documents with at least ``least_words`` words the ``share`` per cent with the highest scores are drawn and
    ranked from 1; the others' rank is null. With runs of several words n_features counts all runs, and the number of
    words is worked out from it.
    """
    found = written(featured(rows, longest, buckets), "features")
    gain = gains(bucket_counts(found, buckets), bucket_counts(featured(target.select("text"), longest, buckets), buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    # of w words there are w + (w - 1) + ... runs of up to `longest` words
    least = sum(max(0, least_words - k) for k in range(longest))
    scored = weighed(found, gain).select("*", (F.col("weight") + noise).alias("score"), (F.col("n_features") >= least).alias("_wm_in"))
    placed = numbered(scored, [F.col("_wm_in").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "_wm_rank")
    n = placed.where("_wm_in").count()
    rank = F.when(F.col("_wm_in") & (F.col("_wm_rank") <= share * n // 100), F.col("_wm_rank"))
    return placed.withColumn("rank", rank).drop("_wm_in", "_wm_rank")


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns as they are."""
    (own,) = free_names(docs, "_wm_row")
    rows, _ = with_row_ids(docs, own)
    chosen = ranked(rows.select(own, "doc_id", "text"), target, **options).where("rank IS NOT NULL").select(own)
    return rows.join(written(chosen, "drawn").hint("merge"), own, "left_semi").select(*docs.columns)
