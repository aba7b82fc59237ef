import random

import pytest

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, row_id string, sid string, count long, size long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source) rows: prose, copies, near copies, shared passages, empty and null texts, odd bytes."""
    rng = random.Random(3)
    base = [prose(rng, rng.randint(3, 160)) for _ in range(40)]
    passage = prose(rng, 40)
    texts = list(base)
    texts += [base[0], base[1] + " ", base[1], "  " + base[2], None, "", None, " \n\t", "x", "x x x", "é ü 漢字 " * 60]
    for i in range(3, 15):
        words = base[i].split(" ")
        for _ in range(3):
            w = list(words)
            for _ in range(max(1, len(w) // 40)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts.append(" ".join(w))
    texts += [f"{prose(rng, 9)}\n{passage}\n{prose(rng, 12)}" for _ in range(6)]
    texts += ["ab" * 400, "ab" * 90, "q" * 350, "a b " * 200]
    sources = ["s1", "s2", None, "", "ä", "s1", "s1"]
    return [(i, t, sources[i % len(sources)]) for i, t in enumerate(texts)]


@pytest.fixture
def frame(spark):
    """Rows as documents with extra columns whose names clash with those used inside."""

    def make(rows):
        full = [(*r, *[None] * (3 - len(r)), "en", None if r[1] is None else len(r[1]), "mine", "mine", 7, 7) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3, "text") if full else spark.createDataFrame([], SCHEMA)

    return make
