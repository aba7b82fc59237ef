"""One query opN_<name> per operator over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm import (
    centroid_clustering,
    exact_dedup,
    line_templates,
    mixing,
    ngram_join,
    ordinal_quality,
    packing,
    personal_data,
    quality_rules,
    secret_scan,
    suffix_dedup,
    target_resampling,
    toxicity,
)
from wardmill.llm.common import read_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_groups(read_documents(spark, folder))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES["op4_exact_dedup"] = op4_exact_dedup
SQL["op4_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.piece_digests(read_documents(spark, folder))


QUERIES["op6_packing"] = op6_packing


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.spans(read_documents(spark, folder))


QUERIES["op7_personal_data"] = op7_personal_data


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(read_documents(spark, folder))


QUERIES["op8_mixing"] = op8_mixing


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(read_documents(spark, folder)).drop("row_id")


QUERIES["op3_quality_rules"] = op3_quality_rules
SQL["op3_quality_rules"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
lines AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, t, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line
  FROM (SELECT doc_id, source, t, unnest(ls) AS l FROM w)),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM lines GROUP BY host),
everywhere AS (SELECT line, count(DISTINCT t) AS n FROM lines GROUP BY line),
frequent AS (
  SELECT f.host, f.line FROM (SELECT host, line, count(DISTINCT t) AS n FROM lines GROUP BY host, line) f
  JOIN hosts ON hosts.host = f.host JOIN everywhere ON everywhere.line = f.line WHERE everywhere.n > 50 OR f.n >= 5 AND f.n > 0.02 * hosts.n),
gone AS (
  SELECT doc_id, count(*) AS n, sum(len(string_split(lines.line, ' '))) AS words
  FROM lines JOIN frequent ON frequent.host = lines.host AND frequent.line = lines.line GROUP BY doc_id)
SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * (n_words - coalesce(words, 0)) >= n_words AS kept,
       coalesce(gone.n, 0) AS n_lines_removed, CAST(n_words - coalesce(words, 0) AS BIGINT) AS n_words_left
FROM base LEFT JOIN gone ON gone.doc_id = base.doc_id
"""


def op10_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    left = line_templates.without_templates(read_documents(spark, folder))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES["op10_line_templates"] = op10_line_templates
SQL["op10_line_templates"] = r"""
WITH d AS (SELECT doc_id, text IS NULL AS none, coalesce(text, '') AS t FROM documents),
raw AS (SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS place FROM d),
masked AS (
  SELECT doc_id, t, place, line,
         trim(regexp_replace(regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS m
  FROM raw),
l AS (SELECT *, string_split(m, ' ') AS w FROM masked WHERE m <> ''),
p AS (SELECT *, struct_pack(n := len(w), lead := array_to_string(w[1:3], ' ')) AS leaf FROM l),
seen AS (SELECT leaf, m, w, count(DISTINCT t) AS docs FROM p GROUP BY leaf, m, w),
exact AS (SELECT leaf, m FROM seen WHERE docs >= 10 AND len(w) <= 3 OR docs >= 3 AND len(w) >= 40),
tokens AS (SELECT leaf, m, docs, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS i FROM seen WHERE len(w) > 3),
later AS (SELECT * FROM tokens WHERE i > 3),
fixed AS (SELECT leaf, i, token FROM later GROUP BY leaf, i, token HAVING sum(docs) >= 10),
marked AS (
  SELECT later.leaf, m, later.i, later.token, CASE WHEN fixed.i IS NOT NULL AND later.token <> '<*>' THEN later.token ELSE '<*>' END AS shown
  FROM later LEFT JOIN fixed ON fixed.leaf = later.leaf AND fixed.i = later.i AND fixed.token = later.token),
templates AS (
  SELECT leaf, m, list(shown ORDER BY i) AS template FROM marked GROUP BY leaf, m
  HAVING coalesce(avg(CASE WHEN shown <> '<*>' THEN 1.0 ELSE 0.0 END) FILTER (token <> '<*>'), 1) >= 0.6),
recurring AS (SELECT p.leaf, template FROM p JOIN templates ON templates.leaf = p.leaf AND templates.m = p.m GROUP BY p.leaf, template HAVING count(DISTINCT t) >= 10),
lines AS (
  SELECT templates.leaf, m FROM templates JOIN recurring ON recurring.leaf = templates.leaf AND recurring.template = templates.template UNION SELECT leaf, m FROM exact),
gone AS (SELECT DISTINCT doc_id, place FROM p JOIN lines ON lines.leaf = p.leaf AND lines.m = p.m),
kept AS (
  SELECT raw.doc_id, string_agg(line, chr(10) ORDER BY raw.place) FILTER (gone.place IS NULL) AS t, count(gone.place) AS n_dropped, count(*) AS n
  FROM raw LEFT JOIN gone ON gone.doc_id = raw.doc_id AND gone.place = raw.place GROUP BY raw.doc_id)
SELECT d.doc_id, CASE WHEN none THEN 0 ELSE n END AS n_lines, n_dropped, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id
"""


def op1_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    model = ordinal_quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return ordinal_quality.scored(docs, model)


QUERIES["op1_ordinal_quality"] = op1_ordinal_quality


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.near_components(read_documents(spark, folder))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


QUERIES["op9_ngram_join"] = op9_ngram_join


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = suffix_dedup.without_repeats(read_documents(spark, folder))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES["op2_suffix_dedup"] = op2_suffix_dedup


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(read_documents(spark, folder))


QUERIES["op5_secret_scan"] = op5_secret_scan


def op11_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text")
    found = target_resampling.ranked(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES["op11_target_resampling"] = op11_target_resampling
SQL["op11_target_resampling"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY doc_id, w),
bw AS (SELECT w, count(*) AS n FROM b GROUP BY w),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
coded AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
         lambda c, x: xor(c >> 8, crc.t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM words, crc),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN coded USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN coded USING (w) GROUP BY bucket),
totals AS (SELECT CAST(coalesce((SELECT sum(n) FROM s), 0) AS DOUBLE) AS s, CAST(coalesce((SELECT sum(n) FROM t), 0) AS DOUBLE) AS t),
gains AS (
  SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (totals.s + 10000) / ((s.n + 1)::DOUBLE * (totals.t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON t.bucket = s.bucket, totals),
weights AS (SELECT doc_id, CAST(sum(dw.n * gain) AS BIGINT) AS weight FROM dw JOIN coded USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(d.w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights ON weights.doc_id = d.doc_id),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranks ON ranks.doc_id = scored.doc_id
"""


def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clustering.cluster_digests(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _rounds_sql(rounds: int) -> str:
    """CTEs c1 to c<rounds> (centroids) and a<rounds + 1> (assignments), from the vectors v and first centroids c0."""
    out = []
    for k in range(1, rounds + 2):
        out.append(f"""
d{k} AS MATERIALIZED (SELECT v.id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS s FROM v JOIN c{k - 1} c ON c.i = v.i GROUP BY v.id, c.k),
a{k} AS MATERIALIZED (SELECT id, CAST(arg_min(k, (s, k)) AS INTEGER) AS cluster, CAST(min(s) AS BIGINT) AS distance FROM d{k} GROUP BY id)""")
        if k <= rounds:
            out.append(f"""
c{k} AS MATERIALIZED (
  SELECT c.k, c.i, coalesce(n.x, c.x) AS x FROM c{k - 1} c
  LEFT JOIN (SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM a{k} JOIN v ON v.id = a{k}.id GROUP BY cluster, i) n
  ON n.cluster = c.k AND n.i = c.i)""")
    return ",".join(out)


QUERIES["op12_centroid_clustering"] = op12_centroid_clustering
SQL["op12_centroid_clustering"] = f"""
WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
n AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS id, list_transform(e, lambda x: CAST(floor(256 * x) AS BIGINT)) AS q FROM e),
v AS MATERIALIZED (SELECT id, unnest(range(1, 65)) AS i, unnest(q) AS x FROM n),
first AS (SELECT id, row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS k FROM n QUALIFY k < 40),
c0 AS MATERIALIZED (SELECT k, i, x FROM first JOIN v ON v.id = first.id),{_rounds_sql(5)},
named AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY k)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a6 JOIN n ON n.id = a6.id JOIN named ON named.k = a6.cluster
"""


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the documents with crc32(doc_id) mod 3 = 1 are held out of the fit."""
    docs = read_documents(spark, folder).select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet").where(~held_out))
    return toxicity.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES["op13_toxicity"] = op13_toxicity
