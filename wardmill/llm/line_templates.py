"""Line dedup by a log-template tree.

A line's leaf is its number of tokens and its leading tokens, with tokens that hold a digit masked. In a leaf, a token
that enough documents have at its place is constant and the others are variable fields; the line with its variable
fields masked is its template. Templates that recur across documents are dropped, with all their lines, if they are mostly
constant beyond the leading tokens, which the leaf has made equal; masked tokens speak neither for nor against. A line of no
more tokens than lead is its own template. A long line without variable fields is dropped from few documents on.
Copies of one text count as one document. DataFrame functions only.

A null text has no lines. Empty lines are left alone. Long texts and lines are read whole. Rows with one id are told
apart by ``row_id`` (see common.with_row_ids) and each gives a row. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import SPACE, with_row_ids, written

FIELD = "<*>"
#: A token with a digit, tried once per token and without going back.
DIGITS = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


#: Parts into which the lines of one leaf or template are dealt for a join.
DEALT = 16


def parsed_lines(rows: DataFrame, depth: int) -> DataFrame:
    """row_id, content, place, leaf (two hashes), the masked line and its hash, for lines with a token."""
    # the text is hashed below the explode: above it Spark would do so for every line
    t = rows.select("row_id", F.coalesce("text", F.lit("")).alias("t")).select("row_id", "t", F.xxhash64("t").alias("content"))
    lines = t.select("row_id", "content", F.posexplode(F.split("t", "\n", -1)).alias("place", "line"))
    fields = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", DIGITS, FIELD)).otherwise(F.col("line"))
    lines = lines.select("row_id", "content", "place", fields.alias("fields"))
    # most lines have single spaces already; looking for anything else is cheaper than replacing each space
    other = reduce(or_, (F.contains("fields", F.lit(c)) for c in ("  ", "\t", "\x0b", "\x0c", "\r")))
    masked = F.trim(F.when(other, F.regexp_replace("fields", SPACE, " ")).otherwise(F.col("fields")))
    lines = lines.select("row_id", "content", "place", masked.alias("masked")).where("masked <> ''")
    lines = lines.withColumn("tokens", F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1)
    lead = F.substring_index("masked", " ", depth)
    return lines.select(
        "row_id", "content", "place", "tokens", "masked",
        F.xxhash64(F.lit(1), "tokens", lead).alias("l1"), F.xxhash64(F.lit(2), "tokens", lead).alias("l2"),
        F.xxhash64(F.lit(3), "masked").alias("m"),
    )


def dealt(few: DataFrame) -> DataFrame:
    """Every row once for each part that its lines are dealt to."""
    return few.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))


def dropped_lines(rows: DataFrame, depth: int = 3, least_docs: int = 10, constant: float = 0.6, long_tokens: int = 40, long_docs: int = 3) -> DataFrame:
    """row_id and the places of its lines that a recurring template has (an array, one row per row_id).

    ``constant``: the part of a template's tokens beyond the leading ``depth`` that must be constant. A template recurs in
    ``least_docs`` documents; one of ``long_tokens`` tokens and more without a variable field in ``long_docs``.
    """
    leaf, line = ["l1", "l2"], ["l1", "l2", "m"]
    # parsed once; what follows reads the columns it needs
    lines = written(parsed_lines(rows, depth).withColumn("part", F.pmod(F.xxhash64("row_id", "place"), F.lit(DEALT)).cast("int")), "lines")
    long = F.col("tokens") >= long_tokens
    # a template's documents are among its leaf's, so other leaves need no further look
    counted = lines.groupBy(*leaf, "tokens").agg(F.count_distinct("content").alias("docs"))
    leaves = written(counted.where((F.col("docs") >= least_docs) | (long & (F.col("docs") >= long_docs))).select(*leaf), "leaves")
    near = written(lines.join(dealt(leaves), [*leaf, "part"], "left_semi"), "candidates")
    # grouped by the text too: a string would not fit a hash aggregate otherwise
    seen = written(near.groupBy(*line, "tokens", "masked").agg(F.count_distinct("content").alias("docs")), "seen")
    exact = seen.where((F.col("docs") >= least_docs) & (F.col("tokens") <= depth) | long & (F.col("docs") >= long_docs)).select(*line)
    tokens = seen.where(F.col("tokens") > depth).select(*line, "docs", F.posexplode(F.split("masked", " ")).alias("at", "token")).where(F.col("at") >= depth)
    tokens = written(tokens, "tokens")
    fixed = tokens.groupBy(*leaf, "at", "token").agg(F.sum("docs").alias("n")).where(F.col("n") >= least_docs)
    marked = tokens.join(fixed, [*leaf, "at", "token"], "left")
    field = F.col("token") == FIELD
    stays = F.col("n").isNotNull() & ~field
    shown = F.when(stays, F.col("token")).otherwise(FIELD)
    templates = (
        marked.groupBy(*line)
        .agg(
            F.bit_xor(F.xxhash64(F.lit(4), "at", shown)).alias("t1"), F.bit_xor(F.xxhash64(F.lit(5), "at", shown)).alias("t2"),
            F.coalesce(F.avg(F.when(~field, stays.cast("int"))), F.lit(1.0)).alias("constant"),
        )
        .where(F.col("constant") >= constant)
        .select(*line, "t1", "t2")
    )
    templates = written(templates, "templates")
    key = [*leaf, "t1", "t2"]
    # a line's documents, each once, before the template's meet
    having = near.select(*line, "part", "content").join(dealt(templates), [*line, "part"]).select(*key, "content")
    recurring = having.groupBy(*key).agg(F.count_distinct("content").alias("docs")).where(F.col("docs") >= least_docs).select(*key)
    gone = written(templates.join(recurring, key, "left_semi").select(*line).unionByName(exact).distinct(), "gone")
    places = near.select("row_id", "place", *line, "part").join(dealt(gone), [*line, "part"], "left_semi")
    return places.groupBy("row_id").agg(F.collect_set("place").alias("places"))


def without_templates(docs: DataFrame, **limits) -> DataFrame:
    """row_id, doc_id, text without the lines of recurring templates, n_lines, n_dropped; one row per row of docs."""
    rows, _ = with_row_ids(docs.select("doc_id", "text"))
    gone = written(dropped_lines(rows, **limits), "dropped")
    joined = rows.join(gone.hint("merge"), "row_id", "left")  # grows with the rows, so it is never sent whole
    lines = F.split("text", "\n", -1)
    left = F.expr("array_join(filter(split(text, '\\n', -1), (x, i) -> NOT array_contains(places, i)), '\\n')")
    return joined.select(
        "row_id",
        "doc_id",
        F.when(F.col("places").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
    )
