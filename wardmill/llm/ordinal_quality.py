"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades: 0 for low quality, 1 for good but toxic, 2 for good and clean. All grades share one vector of weights over
hashed text; ordered thresholds cut its score, P(grade <= k) = logistic(threshold_k - score). The expected grade ranks
documents and the tail probability P(grade = 2) selects them.

The fit reads at most ``sample_rows`` labelled documents, chosen by a hash of their ids, in one task; scoring is one pass
over all rows without a shuffle. A null or empty text has no words and is scored by the thresholds and its shape
alone. Labels with a null quality are left out; of several labels of one document the lowest grade counts; a null toxic
is 0. Without any usable label every document has an even chance and stays, whatever the limit. Rows are scored one by one, so repeated ids or rows
each give a row and a null id stays null. Other columns are kept where rows are filtered and ignored otherwise.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import tidied

BUCKETS = 1 << 17
GRADES = 3
SAMPLE_ROWS = 20_000
#: A word's value is the number of a text's buckets to this negative power.
SCALE = 0.25
#: Documents are kept if they are clean with this probability.
LEAST = 0.8
#: Words a worker remembers; the memory is emptied when full.
REMEMBERED = 300_000
ALNUM = re.compile(r"[\W_]+")
#: One object per bucket, shared by all words that a worker remembers.
NUMBERS = tuple(range(BUCKETS))


def bucket(name: str) -> int:
    return NUMBERS[zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS]


class Features:
    """Buckets of a text: its distinct words, their beginnings, the signs around them, and coarse measures of its shape."""

    def __init__(self):
        self.words: dict[str, tuple[int, ...]] = {}

    def word(self, w: str) -> tuple[int, ...]:
        core = ALNUM.sub("", w)
        signs = w.replace(core, "", 1) if core else w
        found = tuple(bucket(k) for k in (f"w {core}", f"5 {core[:5]}", f"3 {core[:3]}")[: 3 if core else 0])
        found += (bucket(f"s {signs}"),) if signs else ()
        self.words[w] = found
        return found

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of words, each once; buckets of the shape)."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        words = text.lower().split()
        known = self.words
        distinct = set(words)
        found = set()
        for w in distinct:
            found.update(known.get(w) or self.word(w))
        n, chars = max(1, len(words)), max(1, len(text))
        upper = sum(map(str.isupper, words and text.split()))
        level = lambda x, k=10: min(k, int(k * x))
        shape = [
            f"distinct {level(len(distinct) / n)} {min(6, n.bit_length() // 2)}",
            f"upper {level(upper / n)}",
            f"signs {level(sum(map(text.count, '#*$%&|<>!')) / chars, 20)}",
            f"digits {level(sum(map(text.count, '0123456789')) / chars, 20)}",
            f"bars {level(words.count('|') / n)}",
        ]
        return np.fromiter(found, np.int32, len(found)), np.array([bucket(s) for s in shape], np.int32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    #: Whether any label was there to fit; a model without rejects nothing.
    fitted: bool = True

    def score(self, words: np.ndarray, shape: np.ndarray) -> float:
        return float(self.weights[words].sum() / max(1, len(words)) ** SCALE + self.weights[shape].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k below the highest grade, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))

    def keeps(self, tails: np.ndarray, least: float) -> np.ndarray:
        return (tails[:, 1] >= least) | (not self.fitted)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 20, rate: float = 0.5, decay: float = 2e-5, batch: int = 64) -> Model:
    """Minimise the negative log likelihood by AdaGrad over small batches in a fixed shuffled order."""
    weights, thresholds = np.zeros(BUCKETS), np.array([-1.0, 0.0])
    if not rows:
        return Model(weights.astype(np.float32), np.array([-40.0, 0.0]), False)
    grades = np.array([g for g, _, _ in rows])
    share = np.clip(np.array([(grades <= k).mean() for k in range(GRADES - 1)]), 1e-3, 1 - 1e-3)
    thresholds = np.log(share / (1 - share))
    thresholds[1] = max(thresholds[1], thresholds[0] + 0.1)
    of_words = np.array([len(w) for _, w, _ in rows])
    of_shape = np.array([len(s) for _, _, s in rows])
    scale = np.maximum(1, of_words) ** -SCALE
    squares, tsquares = np.full(BUCKETS, 1e-2), np.full(GRADES - 1, 1.0)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        mixed = order.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = mixed[at : at + batch]
            idx = np.concatenate([x for i in part for x in rows[i][1:]])
            sizes = np.column_stack([of_words[part], of_shape[part]]).ravel()
            val = np.repeat(np.column_stack([scale[part], np.ones(len(part))]).ravel(), sizes)
            own = np.repeat(np.repeat(np.arange(len(part)), 2), sizes)
            score = np.bincount(own, weights[idx] * val, len(part))
            cut = np.column_stack([np.full(len(part), -40.0), *(np.full(len(part), t) for t in thresholds), np.full(len(part), 40.0)]) - score[:, None]
            cum = 1 / (1 + np.exp(-np.clip(cut, -40, 40)))
            cum[cut <= -40 + 1e-9] = 0
            cum[:, 0], cum[:, -1] = 0, 1
            slope = cum * (1 - cum)
            g, r = grades[part], np.arange(len(part))
            p = np.maximum(cum[r, g + 1] - cum[r, g], 1e-9)
            by_score = (slope[r, g + 1] - slope[r, g]) / p / len(part)
            by_threshold = np.zeros(GRADES + 1)
            np.add.at(by_threshold, g + 1, -slope[r, g + 1] / p / len(part))
            np.add.at(by_threshold, g, slope[r, g] / p / len(part))
            touched, where = np.unique(idx, return_inverse=True)
            grad = np.bincount(where, by_score[own] * val, len(touched)) + decay * weights[touched]
            squares[touched] += grad * grad
            weights[touched] -= rate * grad / np.sqrt(squares[touched])
            tgrad = by_threshold[1:-1]
            tsquares += tgrad * tgrad
            thresholds = thresholds - 0.1 * tgrad / np.sqrt(tsquares)
            thresholds[1] = max(thresholds[1], thresholds[0] + 1e-2)
    return Model(weights.astype(np.float32), thresholds)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade, one row per labelled document."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) != 0, 1).otherwise(2)
    return labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of a bounded sample of ``labels`` (doc_id, quality, toxic); only sampled ids and the model travel."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for b in batches:
            made = [make(t or "") for t in b.column(2).to_pylist()]
            kind = pa.list_(pa.int32())
            yield pa.record_batch([b.column(0), b.column(1), pa.array([w for w, _ in made], kind), pa.array([s for _, s in made], kind)], names=["doc_id", "grade", "words", "shape"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {}
        for b in batches:
            for i, (d, g) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                w, s = (np.array(b.column(k)[i].values, np.int32) for k in (2, 3))
                w.sort()
                seen.setdefault((d, zlib.crc32(w.tobytes()), len(w)), (g, w, s))
        model = fit([seen[k] for k in sorted(seen)])
        yield pa.record_batch([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.thresholds.tolist()], pa.list_(pa.float64())), pa.array([model.fitted])], names=["weights", "thresholds", "fitted"])

    features = rows.mapInArrow(tidied(featured), "doc_id long, grade int, words array<int>, shape array<int>")
    row = features.repartition(1).mapInArrow(tidied(fitted), "weights binary, thresholds array<double>, fitted boolean").first()
    if row is None:
        return fit([])
    return Model(np.frombuffer(row["weights"], np.float32), np.array(row["thresholds"]), row["fitted"])


def scored(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """doc_id, expected_grade, p_good (P(grade >= 1)), p_clean (P(grade = 2)), kept (p_clean >= least, or no labels)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for b in batches:
            tails = model.tails(np.array([model.score(*make(t.as_py() or "")) for t in b.column(1)], float).reshape(-1))
            yield pa.record_batch(
                [b.column(0), pa.array(tails.sum(1)), pa.array(tails[:, 0]), pa.array(tails[:, 1]), pa.array(model.keeps(tails, least))],
                names=["doc_id", "expected_grade", "p_good", "p_clean", "kept"],
            )

    return docs.select("doc_id", "text").mapInArrow(tidied(work), "doc_id long, expected_grade double, p_good double, p_clean double, kept boolean")


def selected(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that the model keeps; columns as before."""
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for b in batches:
            tails = model.tails(np.array([model.score(*make(t.as_py() or "")) for t in b.column(place)], float).reshape(-1))
            yield b.filter(pa.array(model.keeps(tails, least)))

    return docs.mapInArrow(tidied(work), docs.schema)
