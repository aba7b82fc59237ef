"""Mixing sources to target weights by a low-discrepancy schedule.

Van der Corput points, mapped through the sources' cumulative targets, give every slot of the mix a source. A source's
documents, shuffled by a hash, form a stream that is cut into blocks of equal numbers of words; its slots, by rank,
take its blocks in turn and begin again after the last. A source's last slot is cut where its target is reached, so
what is taken meets the target to the word.

The shuffle is by hash of the id, so reruns agree. Null texts and texts without words have size 0 and are never taken.
A null source is a source of its own, last in order; a null id is an id. Repeated rows are documents of their own.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.common import SPACE, free_names, numbered, with_row_ids, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 1024
#: Slots ranked in one task, and rows of a source summed in one task.
RUN = 4096
#: Cells of the unit interval by which points find their source.
CELLS = 1 << 14
POINT_BITS = 48


def word_count(text: Column) -> Column:
    words = F.size(F.split(F.coalesce(text, F.lit("")), SPACE, -1))
    return (words - F.coalesce(text, F.lit("")).rlike(r"^[\x20\x09-\x0D]").cast("int") - F.coalesce(text, F.lit("")).rlike(r"[\x20\x09-\x0D]\z|^\z").cast("int")).cast("long")


def in_order(rows: DataFrame, order: list[Column], name: str, sums: dict[str, Column], before: bool) -> DataFrame:
    """The rows numbered in ``order``, with sums over the rows before (or up to) each; parts of RUN rows are summed first."""
    placed = numbered(rows, order, name).withColumns({f"_v{i}": v for i, v in enumerate(sums.values())})
    placed = placed.withColumn("_part", F.floor(F.col(name) / RUN))
    parts = placed.groupBy("_part").agg(*[F.sum(f"_v{i}").alias(f"_s{i}") for i in range(len(sums))])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for RUN sources
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).alias(f"_b{i}") for i in range(len(sums))])
    within = Window.partitionBy("_part").orderBy(name).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    out = placed.join(parts, "_part")
    out = out.withColumns({n: F.col(f"_b{i}") + F.coalesce(F.sum(f"_v{i}").over(within), F.lit(0)) for i, n in enumerate(sums)})
    return out.drop("_part", *[f"_{k}{i}" for k in "vb" for i in range(len(sums))])


def targets(sizes: DataFrame) -> DataFrame:
    """sid, source, source_size, target: one row per source.

    A source gets its weight's part of the mix but no more than MOST_PASSES times its size; the excess goes to the
    others by weight until none is above. Sorted by size over weight the capped ones come first, so running sums find
    the level at which the rest are served.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = numbered(totals, [F.col("source").asc_nulls_last()], "sid")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int"))
    named = named.withColumn("w", weight)
    cap = MOST_PASSES * F.col("source_size")
    order = [F.col("source_size") / F.col("w"), F.col("sid")]
    level = written(in_order(named, order, "at", {"caps": cap, "served_weight": F.col("w")}, True), "levels")
    whole = level.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    left_words = F.lit(whole["size"] or 0) * SHARE - F.col("caps")
    level = level.withColumn("level", left_words / (F.lit(whole["w"] or 1) - F.col("served_weight")))
    first = level.agg(F.min(F.when(F.col("level") * F.col("w") <= cap, F.struct("at", "level"))).alias("first")).first()["first"]
    served = F.lit(None).cast("double") if first is None else F.lit(float(first["level"]))
    return level.select("sid", "source", "source_size", F.least(F.coalesce(served * F.col("w"), cap), cap).cast("double").alias("target"))


def running(rows: DataFrame, keys: list[str], part: str, order: list[str], value: str, name: str) -> DataFrame:
    """The sum of ``value`` over earlier rows of a key, summed by parts first so that no key meets in one task."""
    parts = rows.groupBy(*keys, part).agg(F.sum(value).alias("part_sum"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, part, F.coalesce(F.sum("part_sum").over(earlier), F.lit(0)).alias("part_start"))
    within = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    started = rows.join(parts, [*keys, part])
    return started.withColumn(name, F.col("part_start") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("part_start")


def van_der_corput(i: Column) -> Column:
    """The bits of ``i`` mirrored at the point."""
    mirrored = F.reverse(F.lpad(F.bin(i), POINT_BITS, "0"))
    return F.conv(mirrored, 2, 10).cast("double") / float(1 << POINT_BITS)


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).

    documents: row, doc_id, source, sid, size, source_size, target, at (first word in the source's stream).
    pieces: slot, doc_id, row, first (word of the document), words: what each slot of the mix takes, in order.
    """
    spark = docs.sparkSession
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    rows = sizes.count()
    goals = written(targets(sizes), "targets")
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    passes = F.floor(F.floor("target") / F.greatest("source_size", F.lit(1))).cast("long")
    rest = F.floor("target") - passes * F.col("source_size")
    goals = goals.withColumns({"blocks": blocks, "slots": passes * blocks + F.ceil(rest / BLOCK_WORDS)})

    shuffled = F.xxhash64(F.lit(17), "doc_id")
    doc_rows = sizes.join(goals.select("sid", "source", "source_size", "target"), sizes["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    doc_rows = doc_rows.withColumns({"place": shuffled, "part": F.pmod(shuffled, F.lit(rows // RUN + 1))})
    stream = running(doc_rows, ["sid"], "part", ["place", F.col("doc_id").asc_nulls_last(), "size"], "size", "at")
    stream = written(stream.withColumn("row", F.monotonically_increasing_id()), "stream")

    total = goals.agg(F.sum("slots").alias("n")).first()["n"] or 0
    ends = in_order(goals.where("slots > 0").select("sid", "slots", "blocks"), [F.col("sid")], "at", {"upto": F.col("slots")}, False)
    ends = ends.select("sid", "slots", "blocks", (F.col("upto") / float(max(total, 1))).alias("high"), ((F.col("upto") - F.col("slots")) / float(max(total, 1))).alias("low"))
    cells = ends.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.least(F.col("high"), F.lit(1.0)) * CELLS))))
    points = spark.range(total).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("point"))
    points = points.withColumns({"cell": F.floor(F.col("point") * CELLS), "run": F.floor(F.col("slot") / RUN), "one": F.lit(1).cast("long")})
    drawn = points.join(cells, "cell").where("point >= low AND point < high").select("slot", "run", "one", "sid", "slots", "blocks")
    drawn = written(drawn, "drawn")
    ranked = running(drawn, ["sid"], "run", ["slot"], "one", "rank").where("rank < slots").select("slot", "sid", "blocks", "rank")
    # points miss a source's number of slots by a few: the missing ones follow at the end
    short = goals.where("slots > 0").join(drawn.groupBy("sid").count(), "sid", "left").where("slots > coalesce(count, 0)")
    short = short.select("sid", "blocks", F.explode(F.sequence(F.coalesce("count", F.lit(0)), F.col("slots") - 1)).alias("rank"))
    ranked = ranked.unionByName(short.select((F.lit(total) + F.col("rank")).alias("slot"), "sid", "blocks", "rank"))

    lo, hi = F.floor(F.col("at") / BLOCK_WORDS), F.floor((F.col("at") + F.col("size") - 1) / BLOCK_WORDS)
    cut = stream.where("size > 0").select("row", "doc_id", "sid", "at", "size", "source_size", "target", F.explode(F.sequence(lo, hi)).alias("block"))
    taking = ranked.select("slot", "sid", (F.col("rank") % F.col("blocks")).alias("block"), F.floor(F.col("rank") / F.col("blocks")).alias("pass"))
    start = F.greatest("at", F.col("block") * BLOCK_WORDS)
    goal = F.floor("target") - F.col("pass") * F.col("source_size")
    stop = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS, goal)
    pieces = cut.join(taking, ["sid", "block"]).select("slot", "doc_id", "row", (start - F.col("at")).alias("first"), (stop - start).alias("words"))
    return stream, pieces.where("words > 0")


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``."""
    stream, pieces = mix(docs)
    sums = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return stream.join(sums, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each whole pass, and one with the first words where the last pass ends inside.

    Columns as before; the cut text has single spaces, and n_chars, where there is one, follows it.
    """
    own, whole, first, cut = free_names(docs, "row_id", "_whole", "_first", "_cut")
    rows, _ = with_row_ids(docs, own)
    taken = taken_words(rows.select(F.col(own).alias("doc_id"), "text", "source")).where("taken > 0")
    taken = taken.select(F.col("doc_id").alias(own), F.floor(F.col("taken") / F.col("size")).alias(whole), (F.col("taken") % F.col("size")).alias(first))
    copies = F.concat(F.array_repeat(F.lit(0), F.col(whole).cast("int")), F.when(F.col(first) > 0, F.array(first)).otherwise(F.array().cast("array<long>")))
    each = rows.join(written(taken, "taken"), own).withColumn(cut, F.explode(copies))
    words = F.array_remove(F.split("text", SPACE), "")
    text = F.when(F.col(cut) == 0, F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.col(cut).cast("int")), " "))
    each = each.withColumn("text", text)
    if "n_chars" in docs.columns:
        each = each.withColumn("n_chars", F.when(F.col(cut) == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return each.select(*docs.columns)
