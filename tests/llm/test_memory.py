"""Memory that a task's worker keeps for the tasks after it."""

import pyarrow as pa
import pytest

from wardmill.llm import common, packing


def resident_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(next(x for x in f if x.startswith("Rss:")).split()[1]) / 1024


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, f"some text of row {i}") for i in range(20)], "doc_id long, text string").coalesce(1)


def test_packing_leaves_no_freed_memory(rows):
    """The function that a worker runs is taken from the plan's caller and fed in this process."""
    taken = {}

    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            taken["work"] = work
            return rows.limit(0).selectExpr(*[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in schema.split(", ")])

    packing.pieces(Frame())
    batch = pa.record_batch([pa.array(range(20), pa.int64()), pa.array([f"some text of row {i}" for i in range(20)])], names=["doc_id", "text"])
    list(taken["work"](iter([batch])))  # loads the vocabulary
    before, kept = resident_mb(), []

    def batches():
        small = [b"x" * (40_000 + i % 2) for i in range(5_000)]  # too small for maps of their own
        kept.extend(small[::50])  # lies between the others
        del small
        yield batch

    list(taken["work"](batches()))
    assert resident_mb() - before < 60


def test_workers_take_texts_in_slices():
    """The n-gram join's workers never hold the n-grams of a whole batch of long texts; no row is lost or changed."""
    texts = ["a", None, "b" * 3_000_000, "c" * 3_000_000, "", "d" * 9_000_000, None, "e"]
    batch = pa.record_batch([pa.array(range(8), pa.int64()), pa.array(texts)], names=["row_id", "text"])
    empty = batch.slice(0, 0)
    cut = list(common.in_slices(iter([batch, empty, batch.slice(1, 2)]), 1))
    assert [b.num_rows for b in cut] == [3, 2, 1, 2, 2]
    assert [x for b in cut for x in b.column(0).to_pylist()] == [*range(8), 1, 2]
    assert [x for b in cut for x in b.column(1).to_pylist()] == texts + texts[1:3]
