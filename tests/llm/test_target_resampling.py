"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib

import pytest

from wardmill.llm import target_resampling as tr

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def runs(text, longest):
    w = WORD.findall(lowered(text))
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain(rows, target, longest, buckets, least, share):
    code = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for x in texts:
            for f in runs(x, longest):
                counts[code(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for d, text, *_ in rows:
        found = runs(text, longest)
        weight = sum(gain[code(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((d, len(found), weight, score, len(WORD.findall(lowered(text)))))
    ranks = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = ranks[: share * len(ranks) // 100]
    place = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    rest = list(ranks[len(drawn) :]) + [r for r in out if r[4] < least]
    return sorted(map(str, place + [(*r[:4], None) for r in rest]))


@pytest.mark.parametrize(("longest", "buckets", "share"), [(1, 10_000, 10), (2, 97, 50), (3, 70_000, 100)])
def test_against_plain(spark, frame, corpus, longest, buckets, share, monkeypatch):
    monkeypatch.setattr(tr, "SLICE", 3000)
    rows = [*corpus, (None, "No id but many words " * 6, None), (3, corpus[3][1], "again"), (900, "Long TEXT of Ünïcode \x00 x\x01y 1a-2b " * 4000, "s1"), (901, "\x00\x00", "s1")]
    target = [corpus[0][1], None, "", "long text of words x y"]
    got = tr.ranked(frame(rows), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"), longest, buckets, 20, share)
    have = sorted(str((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in got.collect())
    assert have == plain(rows, target, longest, buckets, 20, share)


def test_drawn_keeps_columns(spark, frame, corpus):
    docs = frame([*corpus, corpus[5]])
    target = spark.createDataFrame([(0, corpus[7][1])], "item_id long, text string")
    got = tr.drawn(docs, target, share=30)
    assert got.columns == docs.columns
    eligible = sum(len(WORD.findall(lowered(r[1]))) >= 20 for r in [*corpus, corpus[5]])
    assert got.count() == 30 * eligible // 100 and {r["row_id"] for r in got.collect()} == {"mine"}


def test_empty(spark, frame, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert tr.ranked(frame([]), none).count() == 0
    assert tr.ranked(frame(corpus), none).count() == len(corpus)


def test_no_run_crosses_documents():
    own, codes = tr.occurrences([b"a b", b"", b"c", b"D e f"], 2, 10_000)
    want = [(0, "a"), (0, "b"), (0, "a b"), (2, "c"), (3, "d"), (3, "e"), (3, "f"), (3, "d e"), (3, "e f")]
    assert list(zip(own.tolist(), codes.tolist(), strict=True)) == [(d, zlib.crc32(x.encode()) % 10_000) for d, x in want]
