"""The string kernel against a plain version, and the machine on held-out planted insults."""

import itertools
import random
import zlib

import numpy as np

from tests.llm.conftest import prose
from wardmill.llm import toxicity as tox

INSULTS = ("zwindlo", "krustig", "blomfax")


def planted(n=700, seed=11):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(20, 80)).split(" ")
        bad = rng.random() < 0.25
        if bad:
            for w in rng.sample(INSULTS, 2):
                words.insert(rng.randrange(len(words)), w + rng.choice(["", "s", "!", ","]))
        rows.append((i, " ".join(words), "s1"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def plain_features(string):
    out = {}
    for size in (3, 4):
        for at in itertools.combinations(range(len(string)), size):
            if at[-1] - at[0] < 5:
                key = tuple(string[i] for i in at)
                out[key] = out.get(key, 0) + tox.DECAY ** (at[-1] - at[0] + 1)
    return out


def test_kernel_is_the_subsequence_kernel():
    words = ["idiot", "idxiot", "a", "pathetic", "stu", "zzzzzz"]
    marks = ["\x01idio", "stupid", "\x01zz\x01"]
    got = tox.Landmarks(marks).kernel(words)
    for i, w in enumerate(words):
        f = plain_features(f"\x01{w}\x01")
        for j, m in enumerate(marks):
            g = plain_features(m)
            assert abs(got[i, j] - sum(f[k] * g[k] for k in f.keys() & g.keys())) < 1e-9


def test_strings():
    got = tox.strings_of("You i d i o t, id-iot M.O.R.O.Né x1")
    assert {"you", "idiot", "id", "iot", "x1"} <= got and "moroné" in got
    assert tox.strings_of("") == set() == tox.strings_of(" \n!?")


def test_machine_against_its_objective():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(80, 4)), np.where(rng.random(80) < 0.4, 1.0, -1.0)
    weight = rng.random(80)
    w, b = tox.machine(x, y, weight, penalty=0.1, rounds=100)

    def loss(p):
        return 0.1 * (p[:-1] ** 2).sum() + 1e-8 * p[-1] ** 2 + (weight * np.maximum(0, 1 - y * (x @ p[:-1] + p[-1])) ** 2).sum()

    best = np.append(w, b)
    assert all(loss(best) <= loss(best + rng.normal(size=5) * scale) + 1e-9 for scale in (1e-4, 1e-2, 1) for _ in range(50))


def test_held_out(spark, frame):
    rows, labels = planted()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {d for d, _, _ in labels if zlib.crc32(str(d).encode()) % 3 == 1}
    model = tox.train(frame(rows), table.where(~table.doc_id.isin(*out)))
    got = {r["doc_id"]: r for r in tox.scored(frame(rows), model).collect()}
    truth = {d: t for d, _, t in labels}
    caught = [got[d]["predicted"] for d in out if truth[d]]
    false = [got[d]["predicted"] for d in out if not truth[d]]
    assert np.mean(caught) > 0.95 and np.mean(false) < 0.02
    odd = [(1, None), (1, ""), (None, "good words"), (2, "Z W I N D L O"), (3, "zwi-ndlo"), (4, "x" * 50_000 + " zwindlo " + "y" * 50_000), (4, "kruustig"), (4, "kruustig")]
    told = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["predicted"]) for r in tox.scored(frame(odd), model).collect())
    assert told == [(-1, 0), (1, 0), (1, 0), (2, 1), (3, 1), (4, 1), (4, 1), (4, 1)]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_without_labels(spark, frame, corpus):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for table in (none, none.union(spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 0), (2, 0, 0)], none.schema))):
        got = tox.scored(frame(corpus), tox.train(frame(corpus), table)).collect()
        assert len(got) == len(corpus) and {r["predicted"] for r in got} == {0}
    assert tox.scored(frame([]), tox.train(frame([]), none)).count() == 0


def test_copies_are_one_document():
    rng = random.Random(4)
    a, b = prose(rng, 60), prose(rng, 60)
    near = a.split(" ")
    near[3] = "other"
    assert tox.distinct_documents([tox.strings_of(x) for x in (a, b, " ".join(near), a, "")]) == [0, 1, 4]
