"""Clustering against a plain version with whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from wardmill.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, v int"


def plain(rows, dimensions, clusters, rounds):
    kept = [(i, [max(-cc.LARGEST, min(cc.LARGEST, math.floor(256 * x))) for x in np.array(e, np.float32).astype(float)]) for i, e in rows if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == k]
            if mine:
                centroids[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = [nearest(v) for _, v in kept]
    inertia = sum(d for d, _ in last)
    sums = {k: sum(d for d, o in last if o == k) for _, k in last}
    return sorted(
        str((i, k, d, sums[k], inertia, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()))
        for (i, _), (d, k) in zip(kept, last, strict=True)
    )


@pytest.mark.parametrize(("dimensions", "clusters", "block", "chunk"), [(64, 40, 2, 16_384), (7, 5, 3, 10), (7, 5, 1, 1), (6, 200, 4, 33)])
def test_against_plain(spark, dimensions, clusters, block, chunk):
    rng = random.Random(dimensions + block)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(dimensions)]) for i in range(150)]
    same = [0.25] * dimensions
    rows += [(1000 + i, same) for i in range(80)] + [(7, same), (None, same), (None, rows[0][1])]
    rows += [(2000, None), (2001, []), (2002, same[1:]), (2003, [None, *same[1:]]), (2004, [float("nan"), *same[1:]]), (2005, [float("-inf"), *same[1:]]), (2006, [1e30, -1e30, *same[2:]])]
    df = spark.createDataFrame([(i, e, 1, "mine", "mine", 3) for i, e in rows], SCHEMA).repartition(3, "vec_id")
    got = cc.cluster_digests(df, dimensions=dimensions, clusters=clusters, rounds=3, block=block, chunk=chunk)
    have = sorted(str((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])) for r in got.collect())
    assert have == plain(rows, dimensions, clusters, 3)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cc.cluster_digests(none).count() == 0
    assert cc.cluster_digests(spark.createDataFrame([(1, None, 1, "", "", 1)], SCHEMA)).count() == 0


def test_codes_are_lossless():
    values = np.random.default_rng(1).integers(-3, 3, (500, 9)).astype(np.int32)
    for block in (1, 2, 4, 9):
        codes, entries = cc.encode(values, block)
        assert (np.column_stack([e[c] for c, e in zip(codes, entries, strict=True)]) == values).all()
        assert all(len(np.unique(e, axis=0)) == len(e) for e in entries)
