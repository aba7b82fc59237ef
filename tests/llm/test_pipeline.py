"""The pipeline's stages, each on its predecessor's rows."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_dedup import plain_components
from tests.llm.test_rows import WORD, plain_targets
from wardmill.llm import ordinal_quality
from wardmill.llm.common import read_documents

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_documents(spark, FOLDER)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        before = seen
        seen = stage(spark, before, FOLDER).cache()
        if name != "packing":
            assert seen.columns == docs.columns and seen.dtypes == docs.dtypes
        rows = seen.collect()
        if name == "quality classifier":
            model = ordinal_quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in ordinal_quality.scored(docs, model).where("kept").collect()}
        elif name == "exact dedup":
            assert len({" ".join(r["text"].split()) for r in rows}) == len(rows)
        elif name == "n-gram join":
            assert len({r["doc_id"] for r in rows}) == len(rows) <= before.count()
        elif name == "mixing":
            assert all(r["text"] == texts[r["doc_id"]] or texts[r["doc_id"]].split()[: len(r["text"].split())] == r["text"].split() for r in rows)
    kept = before.count()
    assert sum(r["doc_tokens"] for r in rows if r["start"] == 0) == sum(r["length"] for r in rows)
    assert sum(r["start"] == 0 for r in rows) == kept


@pytest.mark.parametrize("labels", [[], [(0, None, 1), (1, None, None)], [(10**12, 0, 0), (None, 1, 0)]])
def test_quality_stage_without_usable_labels(spark, tmp_path, labels):
    """No label at all, none with a quality, or none of a document: nothing is rejected at the default limit."""
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = read_documents(spark, FOLDER)
    left = corpus_pipeline.quality_stage(spark, docs, str(tmp_path))
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.collect()))
    model = ordinal_quality.train(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    got = ordinal_quality.scored(docs, model).collect()
    assert len(got) == docs.count() and all(r["kept"] and r["p_clean"] == 0.5 for r in got)


def test_near_and_mixing_stages_match_plain_versions(spark):
    """The rows the n-gram stage keeps are the firsts of the components; the mix has each source's target to the word."""
    docs = read_documents(spark, FOLDER)
    near = corpus_pipeline.near_stage(spark, docs, FOLDER).cache()
    rows = docs.collect()
    label = {d: c for d, _, c in plain_components([(r["doc_id"], r["text"]) for r in rows])}
    firsts = {d for d, c in label.items() if d == c}
    kept = near.collect()
    assert 1 < len(firsts) < len(rows) and sorted(r["doc_id"] for r in kept) == sorted(firsts)
    assert {r["doc_id"]: r for r in kept} == {r["doc_id"]: r for r in rows if r["doc_id"] in firsts}
    held, took = Counter(), Counter()
    for r in kept:
        held[r["source"]] += len(WORD.findall(r["text"] or ""))
    for r in corpus_pipeline.mixing_stage(spark, near, FOLDER).collect():
        took[r["source"]] += len(WORD.findall(r["text"]))
    goal = plain_targets(held)
    assert len(goal) > 1 and {s: took[s] for s in goal} == {s: int(n + 1e-6) for s, n in goal.items()} and set(took) <= set(goal)


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
