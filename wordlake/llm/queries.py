"""The registered queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.llm import decontaminate, hard_negatives, html_text, language_id, lexical_search, license_scan, line_crf, near_dup, ngram_join, packing, quality_rules, substring_dedup, suffix_dedup
from wordlake.llm.common import fold, read_table


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), packing.public_path(packing.TOKENIZER_FILE))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_rules.judge(docs, quality_rules.train(docs, labels))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    model = language_id.train(docs.filter(~F.coalesce("held_out", F.lit(False))))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_summary(read_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


def op10_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = line_crf.train(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))
    scored = line_crf.score_lines(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    seventh = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    return hard_negatives.hard_negatives(rows.withColumn("label", F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_html_text": op2_html_text,
    "op3_pack": op3_pack,
    "op4_license_scan": op4_license_scan,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_near_dup": op8_near_dup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_crf": op10_line_crf,
    "op11_ngram_join": op11_ngram_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}

OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) ELSE w END AS s FROM words),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS g FROM classes),
pairs AS (
  SELECT a.rep AS x, b.rep AS y FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT rep AS node, rep AS top FROM classes UNION SELECT l.y, r.top FROM reach r JOIN links l ON l.x = r.node),
tops AS (SELECT node, min(top) AS top FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(t.top, d.doc_id) AS component_id, d.doc_id = coalesce(t.top, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN tops t ON t.node = c.rep
"""

OP9_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
repeats AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM repeats),
gone_lists AS (SELECT doc_id, count(*) AS n, list(i) AS gone FROM gone GROUP BY doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS t FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN gone_lists g USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS g FROM classes),
pairs AS (
  SELECT a.rep AS x, b.rep AS y FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT rep AS node, rep AS top FROM classes UNION SELECT l.y, r.top FROM reach r JOIN links l ON l.x = r.node),
tops AS (SELECT node, min(top) AS top FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(t.top, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN tops t ON t.node = c.rep
"""

OP12_SQL = r"""
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM fine a JOIN fine b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
hard AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5
"""

OP13_SQL = r"""
WITH terms AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
sizes AS (SELECT d, doc_id, count(*) AS n FROM terms GROUP BY d, doc_id),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sizes),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT d, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM items) GROUP BY d, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, nd),
norms AS (SELECT d, doc_id, 50 + (50 * n * nd) // l AS m FROM sizes, totals),
scores AS (
  SELECT i.item_id, t.d, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * m.m))) AS BIGINT) AS score
  FROM items i JOIN tf t USING (term) JOIN weights w USING (term) JOIN norms m ON m.d = t.d GROUP BY i.item_id, t.d)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN (SELECT d, doc_id FROM sizes) USING (d) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

SQL: dict[str, str] = {"op8_near_dup": OP8_SQL, "op9_substring_dedup": OP9_SQL, "op11_ngram_join": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_lexical_search": OP13_SQL}
