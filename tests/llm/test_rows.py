"""Operators that treat rows one by one, quality rules, templates and mixing against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.oracle import compare, connect
from wardmill.llm import line_templates, mixing, ordinal_quality, packing, personal_data, quality_rules, secret_scan
from wardmill.llm.queries import SQL

WORD = re.compile("[^\x20\x09-\x0d]+")


# packing
def test_pieces(frame, corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [*corpus, (900, "It's 12a \x01 x\x01y ΣΣ \x85a\xa0b d́é " * 300), (None, None), (900, "tie"), (900, "tie")]
    got = packing.pieces(frame(rows)).collect()
    whole = defaultdict(list)
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 4096 and r["offset"] == 0 and 1 << r["bucket"] == r["length"]
        whole[r["doc_id"]].append(r)
    assert len({r["sequence_id"] for r in got}) == len(got)
    for d, t, *_ in corpus:
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in whole[d]]).tolist()
        assert ids == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert [r["start"] for r in whole[d]] == np.cumsum([0, *(r["length"] for r in whole[d])])[:-1].tolist() and {r["doc_tokens"] for r in whole[d]} == {len(ids)}
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.piece_digests(frame(corpus)).collect()}
    assert all(digests[r["doc_id"], r["start"]] == zlib.crc32(r["ids"]) for r in got if r["doc_id"] in range(len(corpus)))
    assert packing.pieces(frame([])).count() == 0


def test_cut():
    assert packing.cut(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1] and packing.cut(1, 4096) == [1]


# personal data: the base patterns applied plainly
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and doubled % 10 == 0) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


PII = [
    (1, "é write a.b@c.de@f.gh, x@y, @z.de q@r.st.uv and 1.2.3.4.5.6.7.8 300.1.1.1 1.2.3.4 0001.2.3.255"),
    (2, "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 call +1 (318) 555-6422 +12 +1+2 (34) 5678 90"),
    (3, None), (4, ""), (None, "bank account IBAN DE89 3704 0044 0532 0130 00 or DE89370400440532013001"), (2, "a@b.cd"),
    (5, "social security number 123-45-6789"), (8, "version 123-45-6789 of example"), (6, "1" * 5000 + "." * 10 + "a" * 5000 + "@"), (7, "+" * 50 + "1 " * 400),
]


def test_personal_data(frame):
    got = personal_data.spans(frame(PII)).collect()
    assert len(got) == len(PII)
    by_text = {}
    for d, t in PII:
        base = plain_spans(t or "")
        by_text.setdefault(d, []).append((tuple(Counter(s.split(":")[0] for s in base)[k] for k in PLAIN), hashlib.sha256(",".join(base).encode()).hexdigest(), base))
    for r in got:
        match = [x for x in by_text[r["doc_id"]] if x[:2] == (tuple(r[f"n_{k}"] for k in PLAIN), r["base_sha256"])]
        assert match and set(match[0][2]) <= set(r["spans"].split(",")) | {""}
    added = {r["doc_id"]: (r["n_iban"], r["n_ssn"]) for r in got}
    assert added[None] == (1, 0) and added[5] == (0, 1) and added[8] == (0, 0)
    assert personal_data.spans(frame([])).count() == 0
    clean = {r["text"] for r in personal_data.redacted(frame(PII)).where("doc_id = 2").collect()}
    assert "[email]" in clean and "card [card], 4111-1111-1111-1112 4111111111111111 call [phone] +12 +1[phone]" in clean


def test_checksums():
    assert personal_data.luhn("4111111111111111") and not personal_data.luhn("4111111111111112")
    assert personal_data.mod97("DE89370400440532013000") and not personal_data.mod97("DE88370400440532013000")


@pytest.mark.parametrize(
    ("text", "ibans"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89370400440532013000 2024", ["DE89370400440532013000"]),
        ("DE89370400440532013000 COBADEFFXXX", ["DE89370400440532013000"]),
        ("NO9386011117947 BE68539007547034 AND GB29 NWBK 6016 1331 9268 19 OK", ["NO9386011117947", "BE68539007547034", "GB29 NWBK 6016 1331 9268 19"]),
        ("ORDER AB12 NO93 8601 1117 947 PAID", ["NO93 8601 1117 947"]),
        ("ZZ33 1234 5678 9012 345 TODAY", ["ZZ33 1234 5678 9012 345"]),
        ("DE88370400440532013000 2025", []),
        ("xDE89370400440532013000 2024", []),
    ],
)
def test_iban_before_other_words(text, ibans):
    assert [text[a:b] for a, k, b in personal_data.found(text) if personal_data.KINDS[k] == "iban"] == ibans


# queries with SQL twins, on odd rows
def odd_tables(tmp_path, frame, rows):
    import duckdb

    f = frame(rows).select("doc_id", "text", "lang", "source", "n_chars")
    f.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    return f, con


def test_rules_and_templates_match_sql(tmp_path, frame, corpus):
    lines = [(1000 + i, f"user u{i} logged in from host h{i % 3} at 10:{i}\nother line number {'abcdefghijklmnopqrstuvwxyz'[i % 26]} here\n\n  \nshort", "s1") for i in range(30)]
    spoken = [(2000 + i, "alpha beta gamma delta epsilon zeta\n" + " ".join(f"word{i}x{k}" for k in range(70)), "s2") for i in range(25)]
    f, con = odd_tables(tmp_path, frame, [*corpus, *lines, *spoken, (3000, "a a a a\n" * 30, None), (3001, "# $ % & | < > *\n" * 3, "s1")])
    assert not compare(quality_rules.judged(f).drop("row_id"), con, SQL["op3_quality_rules"])
    from pyspark.sql import functions as F

    left = line_templates.without_templates(f)
    got = left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
    assert not compare(got, con, SQL["op10_line_templates"])
    assert left.agg(F.sum("n_dropped")).first()[0] >= 30


def test_rules_and_templates_odd_rows(frame):
    rows = [(1, "a b c d e\n" * 3, None), (1, "a b c d e\n" * 3, None), (None, None, "s"), (2, "", "s"), (3, "w " * 20000, "s")]
    got = quality_rules.judged(frame(rows))
    assert got.count() == 5 and got.where("doc_id IS NULL AND n_words = 0 AND base_failed AND NOT kept").count() == 1
    assert got.where("doc_id = 3").first()["n_repeat_words"] == 20000
    assert quality_rules.judged(frame([])).count() == 0 and quality_rules.without_frequent_lines(frame(rows)).columns == frame([]).columns
    assert line_templates.without_templates(frame(rows)).count() == 5 and line_templates.without_templates(frame([])).count() == 0


# mixing
def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and rest * weight[s] / w > 2 * sizes[s]}
        if not new:
            return {s: 2 * sizes[s] if s in capped else rest * weight[s] / w for s in names}
        capped |= new


@pytest.mark.parametrize("block", [1024, 7])
def test_mixing(frame, corpus, block, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    got = mixing.taken_words(frame(corpus)).collect()
    sizes = {d: len(WORD.findall(t or "")) for d, t, _ in corpus}
    source = {d: s for d, _, s in corpus}
    by_source, took = Counter(), Counter()
    for d, n in sizes.items():
        by_source[source[d]] += n
    goal = plain_targets(by_source)
    assert len(got) == len(corpus)
    for r in got:
        d = r["doc_id"]
        assert r["size"] == sizes[d] and r["source_size"] == by_source[source[d]] and r["taken"] <= 2 * r["size"]
        assert abs(r["target"] - goal[source[d]]) < 1e-6
        took[source[d]] += r["taken"]
    assert all(took[s] == int(goal[s] + 1e-6) for s in goal)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken_words(frame(corpus)).collect()))


def test_mixed_documents(frame, corpus):
    docs = frame(corpus)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(docs).collect()}
    left = mixing.mixed_documents(docs)
    assert left.columns == docs.columns
    words = Counter()
    for r in left.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert words == Counter({d: n for d, n in taken.items() if n})
    odd = [(1, "a b", None), (1, "a b", None), (None, None, "s"), (2, "", "t")]
    assert mixing.taken_words(frame(odd)).count() == 4 and mixing.taken_words(frame([])).count() == 0 and mixing.mixed_documents(frame([])).count() == 0


# trained models
def test_ordinal_quality(spark, frame):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    kinds = {0: ["zz!!", "qq$$$", "BUY!!"], 1: ["idiot", "scum", "moron"], 2: []}
    rows, labels = [], []
    for i in range(900):
        g = i % 3
        text = [*rng.choice(words, 60), *(rng.choice(kinds[g], 6) if kinds[g] else [])]
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 0 if g == 0 else 1, int(g == 1)))
    docs = frame([*rows, (None, None), (5000, ""), (3, "w1 w2")])
    given = spark.createDataFrame([*labels[:600], (1, 0, 1), (None, 1, 0), (700, None, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(docs, given)
    assert model.thresholds[0] < model.thresholds[1]
    got = ordinal_quality.scored(docs, model).collect()
    assert len(got) == 903 and all(0 <= r["p_clean"] <= r["p_good"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and 600 <= r["doc_id"] < 900]
    right = np.mean([(r["p_clean"] >= 0.5) == (r["doc_id"] % 3 == 2) for r in held])
    ranks = [np.mean([r["expected_grade"] for r in held if r["doc_id"] % 3 == g]) for g in range(3)]
    assert right > 0.95 and ranks[0] < ranks[1] < ranks[2]
    kept = ordinal_quality.selected(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    none = ordinal_quality.train(docs, given.limit(0))
    assert ordinal_quality.selected(docs, none, 0.5).count() == 903 and ordinal_quality.scored(frame([]), model).count() == 0


def test_secret_scan(frame):
    rng = np.random.default_rng(2)
    hexes = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    words = ["river", "stone", "window", "garden", "market", "silver"]
    rows = []
    for i in range(200):
        text = list(rng.choice(words, 30))
        if i % 4 == 0:
            text.insert(7, f'token = "{hexes(40)}"')
        if i % 5 == 0:
            text.insert(15, f"AKIA{''.join(rng.choice(list('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'), 16))}")
        if i % 3 == 0:
            text.insert(20, f"call{rng.integers(10, 99)}@mail.example.com {rng.integers(10**15, 10**16)}")
        rows.append((i, " ".join(text), "s"))
    got = secret_scan.scan(frame([*rows, (None, None, None), (500, "", "s"), (0, rows[0][1], "s")])).collect()
    labelled = [r for r in got if r["label"] is not None]
    assert np.mean([r["is_secret"] == bool(r["label"]) for r in labelled]) > 0.95
    assert sum(r["is_secret"] for r in got) >= 90 and all(rows[r["doc_id"]][1][r["start"] : r["end"]] == r["candidate"] for r in got)
    assert secret_scan.scan(frame([])).count() == 0 and secret_scan.scan(frame([(1, "token = abc123def456ghi7", None)])).first()["probability"] == 1.0


# registered queries
@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twins(spark, name):
    from wardmill.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    assert not compare(QUERIES[name](spark, folder), connect(folder), SQL[name])
