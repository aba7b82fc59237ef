"""Toxicity by a support vector machine on a subsequence string kernel with Nystrom landmarks.

The kernel of two strings counts the subsequences of ORDERS characters they share, each weighted by DECAY to the power
of its stretch in either string, stretches bounded (PATTERNS). So an insult with inserted or missing characters still
shares most of its subsequences. Its features are explicit: one number per hashed subsequence. Landmarks are strings that set
toxic labelled documents apart, and clean strings that come close to them; a string's Nystrom features are its kernel
values with the landmarks, whitened by the landmarks' own kernel matrix. The machine is linear in these, so its
landmarks' expansion is summed into one weight per subsequence, and a new string costs one pass over its characters.

Strings are the words of a text between boundary signs, runs of single letters joined (``i d i o t``), and tokens with their
inner signs left out (``id-iot``); strings longer than LONG are cut into overlapping windows, all of which count. The value of a
sentence is that of its highest string, a document's that of its highest sentence, and a logistic curve fitted on
the labelled documents turns it into a score. Only whole documents are labelled: a toxic one hands its label to the
string that the machine takes for the worst, anew after every fit, and a clean one to all its strings.

The fit reads at most ``toxic_rows`` toxic and ``clean_rows`` clean labelled documents, chosen by a hash of their ids, in
one task; everything else is one pass over all rows without a shuffle. A null or empty text has the score of a text
without any string. Without labels of both kinds every score is the share of toxic labels (0 without labels). Of several
labels of one document the toxic one counts; labels with null are left out. Rows are scored one by one, so repeated ids or rows each
give a row; a null id is held out of nothing and its score is as any. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOXIC_ROWS, CLEAN_ROWS = 800, 2_400
TOXIC_LANDMARKS, CLEAN_LANDMARKS, CLEAN_STRINGS = 64, 64, 10_000
LEAST = 0.7
DECAY = 0.75
#: Character classes: signs, the boundary, a to z, digits, and other letters hashed into the rest.
CLASSES, BOUNDARY, DIGIT, OTHER = 40, 1, 28, 29
#: Places of a subsequence's later characters after its first: 3 or 4 characters in a stretch of up to 5.
PATTERNS = [(a, b) for b in range(2, 5) for a in range(1, b)] + [(a, b, c) for c in range(3, 5) for b in range(2, c) for a in range(1, b)]
SIZES = {2: CLASSES**3, 3: CLASSES**4}
LONG, STEP = 24, 12
#: Bytes of text scored at once.
SLICE = 1 << 20
#: Lengths of the pieces of words that may become toxic landmarks.
PIECES = (4, 5, 6)

#: Values of strings that a worker remembers: the last so many, and as many before these.
REMEMBERED = 200_000

WORD = re.compile(r"[^\W_]+")
SINGLES = re.compile(r"(?<![^\W_])[^\W_](?:[\W_]+[^\W_](?![^\W_])){2,}")


def strings_of(text: str) -> set[str]:
    """The distinct strings of a text that are scored."""
    text = text.lower()
    tokens = set(text.split())
    found = set(filter(str.isalnum, tokens))
    for t in tokens - found:
        parts = WORD.findall(t)
        found.update(parts)
        if len(parts) > 1:
            found.add("".join(parts))
    found.update("".join(WORD.findall(t)) for t in SINGLES.findall(text))
    return found


def class_table() -> np.ndarray:
    """The class of each character of the basic plane; characters beyond share the last place's."""
    codes = np.arange(1 << 16)
    table = OTHER + codes * 7 % (CLASSES - OTHER)
    table[ord("a") : ord("z") + 1] = 2 + np.arange(26)
    table[ord("0") : ord("9") + 1] = DIGIT
    return table.astype(np.int32)


TABLE = class_table()


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    classes = TABLE[np.minimum(codes, (1 << 16) - 1)]
    classes[codes == 1] = BOUNDARY
    return classes


def windows(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes of all windows with boundaries around each string, start of each window, number of the string of each)."""
    cut, own = [], []
    for i, s in enumerate(strings):
        if len(s) <= LONG:
            cut.append(f"\x01{s}\x01")
            own.append(i)
        else:
            whole = f"\x01{s}\x01"
            for at in range(0, len(whole) - LONG + STEP, STEP):
                cut.append(whole[at : at + LONG])
                own.append(i)
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    return classes_of("".join(cut)), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), np.array(own, np.int64)


def subsequences(classes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """For each pattern (order, places of the first characters, codes of the subsequences there, weight)."""
    n = len(classes)
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    room = ends - np.arange(n)  # characters from here to the end of the window
    for pattern in PATTERNS:
        first = np.flatnonzero(room > pattern[-1])
        code = classes[first]
        for step in pattern:
            code = code * CLASSES + classes[first + step]
        yield len(pattern), first, code, DECAY ** (pattern[-1] + 1)


@dataclass(frozen=True)
class Model:
    #: One weight per subsequence of 3 and of 4 characters; none if there was nothing to learn from.
    weights: dict[int, np.ndarray] | None
    slope: float
    offset: float

    def values(self, strings: list[str]) -> np.ndarray:
        """The machine's value of each string: of its highest window."""
        out = np.full(len(strings), -np.inf)
        if not strings or self.weights is None:
            return out
        classes, starts, own = windows(strings)
        total = np.zeros(len(classes), np.float32)
        for order, first, code, weight in subsequences(classes, starts):
            found = self.weights[order][code]
            found *= weight
            total[first] += found
        np.maximum.at(out, own, np.add.reduceat(total, starts))
        return out

    def scores(self, values: np.ndarray) -> np.ndarray:
        """The score of each document by the value of its highest string (-inf: it has none)."""
        if self.weights is None:
            return np.full(len(values), 1 / (1 + np.exp(-self.offset)))
        return 1 / (1 + np.exp(-np.clip(self.slope * np.clip(values, -50, 50) + self.offset, -40, 40)))

    def packed(self) -> tuple:
        found = {k: np.flatnonzero(w) for k, w in (self.weights or {}).items()}
        return (*(x for k in (2, 3) for x in ((found[k].astype("<i4").tobytes(), self.weights[k][found[k]].astype("<f4").tobytes()) if found else (b"", b""))), self.weights is not None, self.slope, self.offset)

    @classmethod
    def unpacked(cls, at2: bytes, w2: bytes, at3: bytes, w3: bytes, fitted: bool, slope: float, offset: float) -> Model:
        if not fitted:
            return cls(None, slope, offset)
        weights = {}
        for k, at, w in ((2, at2, w2), (3, at3, w3)):
            weights[k] = np.zeros(SIZES[k], np.float32)
            weights[k][np.frombuffer(at, "<i4")] = np.frombuffer(w, "<f4")
        return cls(weights, slope, offset)


def pieces(strings: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(strings joined with boundaries, and for every piece of each: hash, number of its string, place, length)."""
    joined = "".join([f"\x01{s}\x01" for s in strings])
    lengths = np.fromiter(map(len, strings), np.int64, len(strings)) + 2
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    own = np.repeat(np.arange(len(strings)), lengths)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    found = []
    for n in PIECES:
        first = np.flatnonzero(room >= n)
        h = np.full(len(first), n, np.uint64)
        for j in range(n):
            h = (h ^ codes[first + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        found.append((h, own[first], first, np.full(len(first), n)))
    return (joined, *(np.concatenate(x) for x in zip(*found, strict=True)))


def distinct_documents(of_docs: list[set[str]], numbers: int = 8, same: int = 4) -> list[int]:
    """Numbers of the documents that are no near copies of an earlier one, by the least hashes of their longer strings."""
    held: list[dict[int, list[int]]] = [{} for _ in range(numbers)]
    out = []
    for i, d in enumerate(of_docs):
        h = np.array([zlib.crc32(s.encode("utf-8", "surrogatepass")) for s in d if len(s) > 5], np.uint64)
        if not len(h):
            out.append(i)
            continue
        least = [int(((h * np.uint64(2 * k + 0x9E3779B97F4A7C15)) >> np.uint64(20)).min()) for k in range(numbers)]
        shared: dict[int, int] = {}
        for k, x in enumerate(least):
            for j in held[k].get(x, ()):
                shared[j] = shared.get(j, 0) + 1
        if max(shared.values(), default=0) >= same:
            continue
        out.append(i)
        for k, x in enumerate(least):
            held[k].setdefault(x, []).append(i)
    return out


def toxic_pieces(toxic: list[set[str]], clean: list[set[str]], most: int) -> list[str]:
    """Pieces of words that toxic documents have and clean ones don't, the clearest first.

    A piece's own count leaves out strings that an earlier piece is in, so what merely comes along with it is not taken. Its numbers of
    toxic and clean documents must be rarer by chance than one in twenty of all pieces tried.
    """
    of_docs = [np.unique(pieces(sorted(d))[1]) for d in toxic]
    tried, having = np.unique(np.concatenate(of_docs), return_counts=True)
    shared, having = tried[having >= 3], having[having >= 3]
    against = np.zeros(len(shared), np.int64)
    for d in clean:
        h = np.unique(pieces(sorted(d))[1])
        at = np.minimum(np.searchsorted(shared, h), max(0, len(shared) - 1))
        against[at[shared[at] == h] if len(shared) else at[:0]] += 1
    share = len(toxic) / (len(toxic) + len(clean))
    limit = np.log(0.05 / max(1, len(tried)))

    def chance(pos, neg):
        """A bound (Chernoff's) on the log probability that at least pos of pos + neg documents are toxic by chance."""
        n, q = pos + neg, pos / np.maximum(1, pos + neg)
        with np.errstate(divide="ignore", invalid="ignore"):
            told = q * np.log(q / share) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - share)), 0)
        return np.where(q > share, -n * told, 0.0)

    clear = chance(having, against)
    tested = np.flatnonzero((clear < limit) & (having > against))
    if not len(tested):
        return []
    shared, against, clear = shared[tested], against[tested], clear[tested]
    strings = sorted(set().union(*toxic))
    number = {s: i for i, s in enumerate(strings)}
    joined, h, own, place, length = pieces(strings)
    at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
    hit = shared[at] == h
    names, where = {}, [[] for _ in shared]
    for k, i, p, n in zip(at[hit].tolist(), own[hit].tolist(), place[hit].tolist(), length[hit].tolist(), strict=True):
        where[k].append(i)
        names.setdefault(k, joined[p : p + n])
    docs_of: list[list[int]] = [[] for _ in strings]
    for d, have in enumerate(toxic):
        for s in have:
            docs_of[number[s]].append(d)
    chosen, explained = [], set()
    queue = [(float(clear[k]), -len(names[k]), names[k], k) for k in range(len(shared))]
    heapq.heapify(queue)
    while queue and len(chosen) < most:
        *_, k = heapq.heappop(queue)
        pos = len({d for i in where[k] if i not in explained for d in docs_of[i]})
        now = float(chance(pos, against[k]))
        if pos <= against[k] or now >= limit:
            continue
        if queue and (now, -len(names[k]), names[k]) > queue[0][:3]:
            heapq.heappush(queue, (now, -len(names[k]), names[k], k))
            continue
        chosen.append(names[k])
        explained.update(where[k])
    return chosen


def explicit(classes: np.ndarray, starts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kernel features of windows as (number of the string, subsequence, value), subsequences of both orders numbered together."""
    window = np.repeat(own, np.diff(np.append(starts, len(classes))))
    found = [(window[first], code + (0 if order == 2 else SIZES[2]), np.full(len(first), weight)) for order, first, code, weight in subsequences(classes, starts)]
    rows, columns, values = (np.concatenate(x) for x in zip(*found, strict=True))
    return rows, columns, values


class Landmarks:
    """Landmark strings (boundary signs included where they have them) and kernel values with them."""

    def __init__(self, strings: list[str]):
        lengths = np.array([len(s) for s in strings], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        rows, columns, values = explicit(classes_of("".join(strings)), starts, np.arange(len(strings)))
        self.used, place = np.unique(columns, return_inverse=True)
        self.rows = np.zeros((len(strings), len(self.used)))
        np.add.at(self.rows, (rows, place.ravel()), values)

    def kernel(self, strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), len(self.rows)))
        for at in range(0, len(strings), 2048):
            r, c, v = explicit(*windows(strings[at : at + 2048]))
            k = np.minimum(np.searchsorted(self.used, c), len(self.used) - 1)
            known = np.flatnonzero(self.used[k] == c)
            known = known[np.argsort(r[known], kind="stable")]
            if len(known):
                shares = self.rows.T[k[known]] * v[known, None]
                held, first = np.unique(r[known], return_index=True)
                out[at + held] = np.add.reduceat(shares, first)
        return out

    def collapsed(self, expansion: np.ndarray) -> dict[int, np.ndarray]:
        """One weight per subsequence from one per landmark."""
        found = expansion @ self.rows
        weights = {2: np.zeros(SIZES[2], np.float32), 3: np.zeros(SIZES[3], np.float32)}
        three = self.used < SIZES[2]
        weights[2][self.used[three]] = found[three]
        weights[3][self.used[~three] - SIZES[2]] = found[~three]
        return weights


def machine(features: np.ndarray, labels: np.ndarray, weight: np.ndarray, penalty: float = 1e-6, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear support vector machine with squared hinge loss, by Newton steps over its support vectors."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-8
    held = None
    for _ in range(rounds):
        inside = labels * (x @ w) < 1
        if held is not None and (inside == held).all():
            break
        held = inside
        s = x[inside] * weight[inside, None]
        w = np.linalg.solve(x[inside].T @ s + np.diag(ridge), s.T @ labels[inside])
    return w[:-1], float(w[-1])


def logistic(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(toxic | value), with the targets drawn in a little so that separate classes have a finite slope."""
    pos, neg = max(1, labels.sum()), max(1, (~labels).sum())
    target = np.where(labels, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * values + b, -40, 40)))
        g = np.array([((p - target) * values).sum() + 1e-4 * a, (p - target).sum()])
        r = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(r * values * values).sum() + 1e-4, (r * values).sum()], [(r * values).sum(), r.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def fit(texts: list[str], labels: list[int], toxic_landmarks: int = TOXIC_LANDMARKS, clean_landmarks: int = CLEAN_LANDMARKS, clean_strings: int = CLEAN_STRINGS, rounds: int = 3) -> Model:
    """A model of labelled texts (1 toxic, 0 clean).

    Of the clean strings the ``clean_strings`` with the highest values and as many others are fitted on in a round.
    """
    y = np.array(labels, bool)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 1e-6
    nothing = Model(None, 0.0, float(np.log(share / (1 - share))))
    if not y.any() or y.all():
        return nothing
    of_docs = [strings_of(t) for t in texts]
    apart = distinct_documents(of_docs)
    of_docs, y = [of_docs[i] for i in apart], y[apart]
    if not y.any() or y.all():
        return nothing
    clean = set().union(*(s for s, k in zip(of_docs, y, strict=True) if not k))
    marks = toxic_pieces([s for s, k in zip(of_docs, y, strict=True) if k], [s for s, k in zip(of_docs, y, strict=True) if not k], toxic_landmarks)
    if not marks:
        return nothing
    distinct = sorted(set().union(*of_docs))
    number = {s: i for i, s in enumerate(distinct)}
    in_clean = np.array([s in clean for s in distinct])
    own = [np.array([i for i in map(number.__getitem__, sorted(s)) if not in_clean[i]], np.int64) for s, k in zip(of_docs, y, strict=True) if k]
    in_toxic = np.bincount(np.concatenate(own), minlength=len(distinct))
    # before the first fit a string's value is 1 if it has all that a toxic landmark has
    near = Landmarks(marks)
    value = np.concatenate([2 * (near.kernel(distinct[i : i + 20_000]) / (near.rows**2).sum(1)).max(1) - 1 for i in range(0, len(distinct), 20_000)])
    others = np.flatnonzero(in_clean)
    some = others[np.argsort([zlib.crc32(distinct[i].encode("utf-8", "surrogatepass")) for i in others], kind="stable")[:clean_strings]]
    hard = others[np.argsort(-value[others], kind="stable")]
    all_marks = Landmarks(marks + [f"\x01{distinct[i][: LONG - 2]}\x01" for i in hard[:clean_landmarks]])
    eigen, vectors = np.linalg.eigh(all_marks.rows @ all_marks.rows.T)
    stays = eigen > 1e-9 * eigen.max()
    whiten = vectors[:, stays] / np.sqrt(eigen[stays])
    model = nothing
    for _ in range(rounds):
        worst = np.unique([d[np.argmax(value[d])] for d in own if len(d)])
        positives = np.union1d(worst[value[worst] > 0.2], np.flatnonzero(~in_clean & (value >= 0.8)))
        if not len(positives):
            break
        negatives = np.union1d(some, others[np.argsort(-value[others], kind="stable")[:clean_strings]])
        rows = np.concatenate([positives, negatives])
        sign = np.where(np.arange(len(rows)) < len(positives), 1.0, -1.0)
        times = in_toxic[positives] / in_toxic[positives].sum()  # an insult with one form counts as much as one with many
        weight = np.concatenate([times, np.full(len(negatives), 1 / len(negatives))])
        w, b = machine(all_marks.kernel([distinct[i] for i in rows]) @ whiten, sign, weight)
        model = Model(all_marks.collapsed(whiten @ w), 1.0, 0.0)
        value = model.values(distinct) + b
    if model.weights is None:
        return nothing
    lowest = float(value.min())
    highest = np.array([max((value[number[s]] for s in d), default=lowest) for d in of_docs])
    slope, offset = logistic(highest, y)
    return Model(model.weights, slope, slope * b + offset)


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1), one row per labelled document."""
    return labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """The model of a bounded sample of ``labels`` (doc_id, toxic); only sampled ids and the model travel."""
    known = labelled(labels)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(toxic_rows).unionByName(known.where("toxic = 0").orderBy(*order).limit(clean_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {}
        for b in batches:
            for d, k, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                t = t or ""
                seen.setdefault((d, zlib.crc32(t.encode("utf-8", "surrogatepass")), len(t)), (t, k))
        kept = [seen[k] for k in sorted(seen)]
        model = fit([t for t, _ in kept], [k for _, k in kept])
        yield pa.record_batch([pa.array([x]) for x in model.packed()], names=["at2", "w2", "at3", "w3", "fitted", "slope", "offset"])

    row = rows.repartition(1).mapInArrow(fitted, "at2 binary, w2 binary, at3 binary, w3 binary, fitted boolean, slope double, offset double").first()
    return fit([], []) if row is None else Model.unpacked(*map(lambda x: bytes(x) if isinstance(x, bytearray) else x, row))


def scored(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """doc_id, score and predicted of every row."""
    state = model.packed()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.unpacked(*state)
        value: dict[str, float] = {}
        before: dict[str, float] = {}
        for b in batches:
            texts, size, first = [], 0, 0
            for i in range(b.num_rows):
                texts.append(strings_of(b.column(1)[i].as_py() or ""))
                size += sum(map(len, texts[-1])) + 1
                if size < SLICE and i + 1 < b.num_rows:
                    continue
                if len(value) > REMEMBERED:
                    value, before = {}, value
                new = set().union(*texts).difference(value)
                value.update({s: before[s] for s in new.intersection(before)})
                new = list(new.difference(before))
                value.update(zip(new, own.values(new).tolist(), strict=True))
                highest = np.array([max(map(value.__getitem__, t), default=-np.inf) for t in texts])
                score = own.scores(highest)
                yield pa.record_batch([b.column(0).slice(first, len(texts)), pa.array(score), pa.array((score >= least).astype(np.int32))], names=["doc_id", "score", "predicted"])
                texts, size, first = [], 0, i + 1

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double, predicted int")
