"""Quality rules: base counts of a text and the frequency of its lines across documents.

Lines are normalised and hashed, distinct documents are counted per host and over all hosts, lines above a limit are
removed, and documents that lose more than half of their words are rejected. Either of three limits suffices: many
documents of the host, many over all hosts, or a few that are a large share of a small host. Copies of one text count as
one document, so being copied does not make a text's own lines frequent. The host is the column ``source``; a null
source is a host of its own. DataFrame functions only.

A null text has no words and fails. Long texts are read whole. Rows with one id are told apart by ``row_id`` (see
common.with_row_ids) and each gives a row. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import SPACE, free_names, with_row_ids, written

WORDLESS = r"[^\x20\x09-\x0D]"


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def with_repeated_words(df: DataFrame, words: str) -> DataFrame:
    """Adds n_repeat_words: the words of ``words`` that lie in a three-word window found twice or more.

    Windows are hashed. Only a text that has equal ones sorts them, keeps those with an equal neighbour, and sums
    what each adds to the words covered so far.
    """
    n = f"greatest(size({words}) - 2, 0)"
    zipped = f"arrays_zip(slice({words}, 1, {n}), slice({words}, 2, {n}), slice({words}, 3, {n}))"
    steps = {
        "_win": f"transform({zipped}, x -> xxhash64(x))",
        "_at": "CASE WHEN size(_win) > size(array_distinct(_win)) THEN sequence(0, size(_win) - 1) END",
        "_sorted": "sort_array(arrays_zip(_win, _at))",
        "_here": "_sorted._win",
        "_place": "_sorted._at",
        "_before": "concat(array(NULL), _here)",
        "_after": "slice(_here, 2, size(_here))",
        "_twice": "filter(arrays_zip(_place, _here, _before, _after), z -> z._here = z._before OR z._here = z._after)",
        "_starts": "array_sort(_twice._place)",
        "n_repeat_words": "coalesce(aggregate(_starts, named_struct('n', 0L, 'last', -3), "
        "(a, p) -> named_struct('n', a.n + least(3, p - a.last), 'last', p), a -> a.n), 0L)",
    }
    for name, step in steps.items():
        df = df.withColumn(name, F.expr(step))
    return df.drop(*(c for c in steps if c.startswith("_")))


def base_counts(rows: DataFrame) -> DataFrame:
    """row_id, doc_id and the base counts, one pass over the text without a shuffle."""
    t = rows.select("row_id", "doc_id", F.coalesce("text", F.lit("")).alias("t"))
    split = t.select("*", words_of("t").alias("w"), F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORDLESS)).alias("lines"))
    counted = split.select(
        "row_id",
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "w",
    )
    covered = with_repeated_words(counted, "w").drop("w")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return covered.withColumn("base_failed", failed)


def hashed_lines(rows: DataFrame) -> DataFrame:
    """row_id, host, content, two hashes of the normalised line, and its number of words; lines without words go."""
    t = rows.select("row_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("host"), F.coalesce("text", F.lit("")).alias("t"))
    t = t.withColumn("content", F.xxhash64("t"))  # below the explode: above it Spark would hash the text for every line
    lines = t.select("row_id", "host", "content", F.explode(F.split("t", "\n", -1)).alias("line")).where(F.col("line").rlike(WORDLESS))
    normal = F.lower(F.trim(F.regexp_replace("line", SPACE, " ")))
    lines = lines.select("row_id", "host", "content", normal.alias("line"))
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return lines.select(
        "row_id", "host", "content", F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"), words.cast("long").alias("words")
    )


def judged(docs: DataFrame, many: int = 50, few: int = 5, share: float = 0.02) -> DataFrame:
    """Base counts, n_lines_removed, n_words_left and kept for every row.

    A line is above the limit if more than ``many`` distinct documents of its host or of all hosts have it, or at least
    ``few`` and more than ``share`` of its host's.
    """
    rows, _ = with_row_ids(docs.select("doc_id", "text", "source"))
    lines = written(hashed_lines(rows), "lines")
    hosts = written(lines.groupBy("host").agg(F.count_distinct("content").alias("host_docs")), "hosts")
    # a line of few documents over all hosts has few in each
    everywhere = written(lines.groupBy("h1", "h2").agg(F.count_distinct("content").alias("docs")).where(F.col("docs") >= few), "everywhere")
    by_host = lines.join(everywhere.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("host", "h1", "h2").agg(F.count_distinct("content").alias("host_has"))
    frequent = (
        by_host.join(everywhere, ["h1", "h2"])
        .join(hosts, "host")
        .where((F.col("docs") > many) | (F.col("host_has") >= few) & (F.col("host_has") > share * F.col("host_docs")))
        .select("host", "h1", "h2")
    )
    removed = (
        lines.join(written(frequent, "frequent"), ["host", "h1", "h2"])
        .groupBy("row_id")
        .agg(F.sum("words").alias("gone"), F.count("*").alias("n_lines_removed"))
    )
    out = base_counts(rows).join(removed, "row_id", "left")
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    return out.select(
        "row_id", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (2 * left >= F.col("n_words"))).alias("kept"),
        F.coalesce("n_lines_removed", F.lit(0)).cast("long").alias("n_lines_removed"),
        left.alias("n_words_left"),
    )


def without_frequent_lines(docs: DataFrame) -> DataFrame:
    """The documents that are kept; columns as before."""
    (own,) = free_names(docs, "row_id")
    rows, _ = with_row_ids(docs, own)
    verdict = judged(rows.select(F.col(own).alias("doc_id"), "text", "source")).where("kept").select(F.col("row_id").alias(own))
    return rows.join(written(verdict, "kept"), own, "left_semi").select(*docs.columns)
