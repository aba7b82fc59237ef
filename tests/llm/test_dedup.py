"""Exact dedup, repeated byte strings and the n-gram join against plain versions."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pytest

from wardmill.llm import exact_dedup, ngram_join, suffix_dedup
from wardmill.llm.components import components

SPACE = re.compile("[\x20\x09-\x0d]+")
ODD_ROWS = [(5, "a b"), (5, "a b"), (None, "a b"), (None, None), (2, None), (2, ""), (7, "x" * 260), (7, "x" * 260), (1, "y" + "x" * 259)]


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 63, 500, dtype=np.uint64) >> np.uint64(1) for _ in range(3)]
    parts[1][:100] = parts[0][:100]
    parts[2][:5] = parts[2][0]
    bits = 47
    blobs = [exact_dedup.build_filter(p[p >> np.uint64(63) == 0], bits) for p in parts]
    values, counts = exact_dedup.merge_filters(0, blobs, bits)
    whole, expected = np.unique(np.concatenate(parts), return_counts=True)
    block = whole >> np.uint64(63) == 0
    # quotients above the block's 16 bits belong to other blocks
    assert counts.sum() == sum(map(len, parts))
    assert len(values) == len(np.unique(np.concatenate(parts) & np.uint64((1 << 63) - 1))) and expected[block].max() == counts.max()


def plain_exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(d)
    return {(d, min(g), len(g), d == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g}


def test_exact_groups(frame, corpus):
    got = exact_dedup.exact_groups(frame(corpus)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert len(got) == len(corpus)
    assert {tuple(r) for r in got} == plain_exact([r[:2] for r in corpus])


def test_exact_odd_rows(frame):
    got = [tuple(r) for r in exact_dedup.exact_groups(frame(ODD_ROWS)).select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert sorted(got, key=str) == sorted(
        [(5, 5, 3, True), (5, 5, 3, False), (None, 5, 3, False), (2, 2, 3, True), (2, 2, 3, False), (None, 2, 3, False), (7, 7, 2, True), (7, 7, 2, False), (1, 1, 1, True)],
        key=str,
    )
    left = exact_dedup.drop_copies(frame(ODD_ROWS))
    assert left.columns == frame([]).columns and left.count() == 4
    assert exact_dedup.exact_groups(frame([])).count() == 0 and exact_dedup.drop_copies(frame([])).count() == 0


def plain_repeats(rows, length=100):
    seen, out = set(), []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("most", [50_000, 2])
def test_repeated_strings(frame, corpus, most):
    got = suffix_dedup.without_repeats(frame(corpus), most).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted((*r[:4], bytes(r[4])) for r in got) == plain_repeats([r[:2] for r in corpus])


def test_repeated_strings_odd_rows(frame):
    got = suffix_dedup.without_repeats(frame(ODD_ROWS)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    order = sorted(ODD_ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert sorted(map(str, ((*r[:4], bytes(r[4])) for r in got))) == sorted(map(str, plain_repeats(order)))
    assert suffix_dedup.without_repeats(frame([])).count() == 0


def grams(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_components(rows):
    sets = {d: grams(t) for d, t in rows}
    label = {d: d for d in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {(d, len(sets[d]), label[d]) for d in sets}


@pytest.mark.parametrize("block", [256, 4])
def test_near_components(frame, corpus, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = ngram_join.near_components(frame(corpus)).select("doc_id", "n_shingles", "component_id").collect()
    assert len(got) == len(corpus)
    assert {tuple(r) for r in got} == plain_components([r[:2] for r in corpus])


def test_cross_links_finds_what_stars_miss(spark, frame):
    """Neighbours in a chain link, the ends don't; without stars all links come from the blocks."""
    words = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(words[2 * k : 2 * k + 80])) for k in range(12)]
    docs = frame(rows).selectExpr("doc_id AS row_id", "doc_id", "text")
    sets = ngram_join.classes(docs).selectExpr("row_id AS rep", "n")
    members = sets.selectExpr("rep", "n", "0L AS family", "rep AS label")
    found = ngram_join.cross_links(members, ngram_join.segments(docs, sets.select("rep")).cache())
    expected = {(a, b) for (a, s), (b, t) in combinations(rows, 2) if 100 * len(grams(s) & grams(t)) >= 80 * len(grams(s) | grams(t))}
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 11
    assert {r["label"] for r in components(found).collect()} == {0}


def test_near_odd_rows(frame):
    rows = [(3, "a b c d e f"), (3, "A b c d e f"), (None, "a  b c d e f"), (4, None), (None, ""), (6, "a b"), (8, "a B"), (9, "b a")]
    got = sorted((str(tuple(r)) for r in ngram_join.near_components(frame(rows)).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(map(str, [(3, 2, 3), (3, 2, 3), (None, 2, 3), (4, 0, 4), (None, 0, None), (6, 1, 6), (8, 1, 6), (9, 1, 9)]))
    left = ngram_join.drop_near_copies(frame(rows))
    assert left.columns == frame([]).columns and left.count() == 5
    assert ngram_join.near_components(frame([])).count() == 0
