"""Secret scans: a random forest over candidate strings removes false positives.

Candidates are the values of assignments to secret-like names, strings of known providers' formats, and other runs of
token characters that hold a digit. Features are the candidate's length and kinds of characters, the likelihood of its
character transitions in the corpus, the share of it that dictionary words cover, its document's path, and the words
before and after it. The forest is Spark's own, trained on labelled findings: a table of reviewed candidates.

Where no reviewed table is given, rules label the clear cases by what is not among the features: provider formats and assignments
to secret-like names are secrets, addresses and runs that neither hold a letter nor a digit among letters are not; the rest is left to the forest. Training
reads at most ``sample_rows`` distinct labelled candidates, half of each label, chosen by a hash, so no string's copies fill it.
Transitions and dictionary are counted over all documents; the dictionary holds words that a set share of documents have,
so its size has a bound whatever the number of documents.

A null or empty text has no candidates. Long texts are read whole. A null path is a path of its own. Rows are scanned
one by one, so repeated ids or rows give findings of their own and a null id stays null. Other columns are ignored. With no
or one-sided labels every candidate keeps the share of secrets among them as its probability. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import written

SAMPLE_ROWS = 20_000
#: A dictionary word is in at least this share of the documents.
DICTIONARY_SHARE = 0.002
NEIGHBOURS, NEIGHBOUR_BUCKETS, PATH_BUCKETS = 2, 16, 8
FIELDS = "doc_id long, start long, end long, kind string, candidate string, path string, before array<string>, after array<string>"

PROVIDER = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})(?![A-Za-z0-9])")
ASSIGNED = re.compile(r"(?i)\b(?:[a-z0-9]+[_-]){0,3}(?:token|secret|password|passwd|pwd|api[_-]?key|key|auth)\b[\"']?\s{0,3}[=:]\s{0,3}(?P<quote>[\"']?)(?P<value>[^\s\"']{6,})(?P=quote)")
RUN = re.compile(r"(?<![A-Za-z0-9_/+=.@-])(?=[A-Za-z_/+=.@-]*[0-9])[A-Za-z0-9_/+=.@-]{8,}(?![A-Za-z0-9_/+=.@-])")
WORD = re.compile(r"[^\W\d_]+")


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), the stronger kind where spans meet, in order."""
    found = [(m.start(), m.end(), "provider") for m in PROVIDER.finditer(text)]
    taken = {i for a, b, _ in found for i in range(a, b)}
    for kind, spans in (("assigned", (m.span("value") for m in ASSIGNED.finditer(text))), ("run", (m.span() for m in RUN.finditer(text)))):
        for a, b in spans:
            if a not in taken and b - 1 not in taken:
                found.append((a, b, kind))
                taken.update(range(a, b))
    return sorted(found)


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """FIELDS for every candidate of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in range(8)]
            for i in range(b.num_rows):
                text = b.column(1)[i].as_py() or ""
                for a, e, kind in candidates(text):
                    before = WORD.findall(text[max(0, a - 60) : a].lower())[-NEIGHBOURS:]
                    after = WORD.findall(text[e : e + 60].lower())[:NEIGHBOURS]
                    for o, v in zip(out, (i, a, e, kind, text[a:e], i, before, after), strict=True):
                        o.append(v)
            ids, paths = (b.column(k).take(pa.array(out[0], pa.int64())) for k in (0, 2))
            text_list = pa.list_(pa.string())
            yield pa.record_batch(
                [ids, pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()), pa.array(out[4], pa.string()), paths, pa.array(out[6], text_list), pa.array(out[7], text_list)],
                names=["doc_id", "start", "end", "kind", "candidate", "path", "before", "after"],
            )

    return docs.select("doc_id", "text", F.col(path).cast("string").alias("path")).mapInArrow(work, FIELDS)


def transitions(docs: DataFrame) -> np.ndarray:
    """Log likelihood of each ASCII character after another, over all documents (128 by 128, smoothed)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(128 * 128, np.int64)
        for b in batches:
            for value in b.column(0):
                data = np.frombuffer((value.as_py() or "").encode(), np.uint8)
                plain = (data[:-1] < 128) & (data[1:] < 128)
                total += np.bincount(data[:-1][plain].astype(np.int64) * 128 + data[1:][plain], minlength=128 * 128)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["pair", "n"])

    counts = np.ones(128 * 128)
    for r in docs.select("text").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r["pair"]] += r["n"]
    table = counts.reshape(128, 128)
    return np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> frozenset[str]:
    """Lower-case words of 3 to 12 letters that at least ``share`` of the documents have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter[str] = Counter()
            for value in b.column(0):
                seen.update({w for w in (value.as_py() or "").lower().split() if 3 <= len(w) <= 12})
            words = [w for w in seen if w.isalpha()]
            yield pa.record_batch([pa.array(words, pa.string()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"])

    least = max(2, share * docs.count())
    words = docs.select("text").mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return frozenset(r["word"] for r in words.select("word").collect())


def covered(text: str, words: frozenset[str]) -> float:
    """The share of the letters that dictionary words cover, the longest taken first from the left."""
    letters, i, hit = text.lower(), 0, 0
    while i < len(letters):
        for n in range(min(12, len(letters) - i), 2, -1):
            if letters[i : i + n] in words:
                hit, i = hit + n, i + n
                break
        else:
            i += 1
    return hit / max(1, sum(map(str.isalpha, text)))


def bucket(text: str, n: int) -> int:
    return zlib.crc32(text.encode()) % n


def features(text: str, path: str | None, before: list[str], after: list[str], table: np.ndarray, words: frozenset[str]) -> list[float]:
    n = len(text)
    codes = [min(127, ord(c)) for c in text]
    steps = [float(table[a, b]) for a, b in zip(codes, codes[1:], strict=False)] or [0.0]
    counts = Counter(text)
    kinds = [sum(map(f, text)) / n for f in (str.isdigit, str.isupper, str.islower)]
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(text, text[1:], strict=False)) / n
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    out = [n, *kinds, 1 - sum(kinds), changes, entropy, sum(steps) / len(steps), min(steps), covered(text, words), float(all(c in "0123456789abcdefABCDEF" for c in text))]
    out += [float(bucket(path or "", PATH_BUCKETS) == k) for k in range(PATH_BUCKETS)]
    for near in (before, after):
        seen = {bucket(w, NEIGHBOUR_BUCKETS) for w in near}
        out += [float(k in seen) for k in range(NEIGHBOUR_BUCKETS)]
    return out


def rule_label(kind: str, text: str) -> int | None:
    """1 secret, 0 no secret, None for the forest to say."""
    if kind == "provider" or kind == "assigned" and re.search("[0-9]", text) and re.search("[A-Za-z]", text):
        return 1
    if "@" in text or not re.search("[A-Za-z]", text) or re.fullmatch(r"[A-Za-z]+[.,:;-]?[0-9]{1,4}[.,:;-]?", text):
        return 0
    return None


def featured(found: DataFrame, table: np.ndarray, words: frozenset[str]) -> DataFrame:
    """The findings with ``features`` and ``label`` (null where no rule speaks)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(b.column(k).to_pylist() for k in ("kind", "candidate", "path", "before", "after")), strict=True))
            made = [features(c, p, x, y, table, words) for _, c, p, x, y in rows]
            labels = [rule_label(k, c) for k, c, _, _, _ in rows]
            kept = [b.column(k) for k in ("doc_id", "start", "end", "kind", "candidate")]
            yield pa.record_batch([*kept, pa.array(made, pa.list_(pa.float64())), pa.array(labels, pa.int32())], names=["doc_id", "start", "end", "kind", "candidate", "features", "label"])

    return found.mapInArrow(work, "doc_id long, start long, end long, kind string, candidate string, features array<double>, label int")


def forest(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = 20, depth: int = 6):
    """A fitted model of ``labelled`` (findings with features and label), or the share of secrets if there is one kind only.

    Copies of a candidate count once per label, with the features of the first.
    """
    shown = labelled.where("label IS NOT NULL").groupBy("candidate", "label").agg(F.min(F.struct("doc_id", "start", "features"))["features"].alias("features"))
    part = lambda k: shown.where(F.col("label") == k).orderBy(F.xxhash64("candidate"), "candidate").limit(sample_rows // 2)
    sample = written(part(0).unionByName(part(1)), "labelled")
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(totals) < 2:
        return float(next(iter(totals), 0))
    weight = F.when(F.col("label") == 1, sum(totals.values()) / (2 * totals[1])).otherwise(sum(totals.values()) / (2 * totals[0]))
    rows = sample.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"), weight.alias("weight"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=5, weightCol="weight").fit(rows)


def scan(docs: DataFrame, path: str = "source", least: float = 0.5, reviewed: DataFrame | None = None) -> DataFrame:
    """doc_id, start, end, kind, candidate, label, probability, is_secret for every candidate.

    ``reviewed``: labelled findings (candidate, label 0 or 1); of several labels of one candidate the higher counts, null
    ones don't. Without them ``label`` is that of the rules.
    """
    rows = written(featured(findings(docs, path), transitions(docs), dictionary(docs)), "findings")
    if reviewed is not None:
        told = reviewed.where("candidate IS NOT NULL AND label IS NOT NULL").groupBy("candidate").agg(F.max((F.col("label") != 0).cast("int")).alias("label"))
        rows = written(rows.drop("label").join(told, "candidate", "left"), "reviewed")
    model = forest(rows)
    if isinstance(model, float):
        told = rows.withColumn("probability", F.lit(model))
    else:
        told = model.transform(rows.withColumn("features", array_to_vector("features"))).withColumn("probability", vector_to_array("probability")[1])
    return told.select("doc_id", "start", "end", "kind", "candidate", "label", "probability", (F.col("probability") >= least).alias("is_secret"))
