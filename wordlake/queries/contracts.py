"""Queries of an edition's contract: digests, markers of repaired rows, the stored index, raw sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.operators.lineage import cut_lineage, fresh_path
from wordlake.operators.sets import MergeRefused
from wordlake.plans import assemble, contract, relations, select
from wordlake.queries.jobs import EDITION_PHRASES, EDITION_ROWS, EDITION_SQL, SHARDS, edition, pick, term_entries


def contract_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The edition's sizes and digests; the digests of the same edition made from dealt-out tables are the same."""
    c = edition(spark, sf)
    again = contract.contract_of(select.Candidate(c.entries, c.provenance.repartition(7), c.queue.repartition(5, "owner")), EDITION_ROWS, SHARDS)
    m = contract.contract_of(c, EDITION_ROWS, SHARDS)
    same = m.join(F.broadcast(again.select(F.col("candidate_digest").alias("again"))))
    return same.select("version", "policy", "n_rows", "n_words", "n_phrases", "n_queue", "shards", F.length("candidate_digest").alias("digits"), (F.col("again") == F.col("candidate_digest")).alias("same"))


def contract_codes(spark: SparkSession, sf: str) -> DataFrame:
    """What the contract says of editions with one table or the manifest changed, each named by ``change``."""
    c = edition(spark, sf)
    m = cut_lineage(contract.contract_of(c, EDITION_ROWS, SHARDS))
    expected = cut_lineage(select.repair_queue(c.entries, SHARDS))
    third = F.col("id") % 3 == 0
    changed = {
        "none": (c, m),
        "keys": (select.Candidate(c.entries, c.provenance.withColumn("term_key", F.when(third, F.concat("term_key", F.lit("x"))).otherwise(F.col("term_key"))), c.queue), m),
        "content": (select.Candidate(c.entries, c.provenance.withColumn("content_digest", F.when(third, "0").otherwise(F.col("content_digest"))), c.queue), m),
        "owners": (select.Candidate(c.entries, c.provenance, c.queue.withColumn("owner", F.when(third, (F.col("owner") + 1) % SHARDS).otherwise(F.col("owner")))), m),
        "queue": (select.Candidate(c.entries, c.provenance, c.queue.filter(~third)), m),
        "version": (c, m.withColumn("version", F.lit(9))),
        "counts": (c, m.withColumn("n_phrases", F.col("n_phrases") + 1)),
        "digest": (c, m.withColumn("candidate_digest", F.reverse("candidate_digest"))),
        "twice": (c, m.unionByName(m)),
        "lost": (c, m.limit(0)),
    }
    rows = [contract.contract_violations(x, manifest, expected, EDITION_ROWS).select(F.lit(name).alias("change"), "code") for name, (x, manifest) in changed.items()]
    lost = contract.missing_tables({"entries": c.entries, "queue": c.queue}, m).select(F.lit("tables").alias("change"), F.concat_ws(":", "code", "example").alias("code"))
    return reduce(DataFrame.unionByName, [*rows, lost])


def index_codes(spark: SparkSession, sf: str) -> DataFrame:
    """An index of the edition with stale, lost and foreign postings against the edition's own."""
    c = edition(spark, sf)
    stale = c.entries.withColumn("definition", F.when(F.col("id") % 6 == 0, F.concat_ws(" ", "definition", F.lit("stale"))).otherwise(F.col("definition"))).filter("id % 10 <> 1")
    index = contract.entry_index(stale)
    foreign = index.filter("id % 15 = 0").withColumn("id", F.col("id") + 1_000_000_000)
    return contract.index_violations(c.entries, index.unionByName(foreign).repartition(6, "term"))


def marked_preflight(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of all owners on a later day: gone, changed without being queued, or queued and changed with no marker or a wrong one."""
    e = term_entries(spark, sf)
    c = edition(spark, sf, e)
    digest = contract.contract_of(c, EDITION_ROWS, SHARDS).first()["candidate_digest"]
    owner = F.pmod(F.col("id"), F.lit(SHARDS))
    later = e.withColumn("definition_zh", F.when(F.col("id") % 8 == 0, "新").otherwise(F.col("definition_zh"))).filter("id % 29 <> 0").withColumn("enrichment", F.lit('{"status":"partial","tries":[1,2]}'))
    due = later.filter("id % 8 = 0")
    marked = [
        contract.with_marker(due.filter("id % 5 = 0"), digest, owner),
        contract.with_marker(due.filter("id % 5 = 1"), "another", owner),
        contract.with_marker(due.filter("id % 5 = 2"), digest, (owner + 1) % SHARDS),
        contract.with_marker(due.filter("id % 5 = 3"), digest, owner).withColumn("definition_zh", F.lit("later still")),
        due.filter("id % 5 = 4").withColumn("enrichment", pick("id", "not json", None)),
    ]
    return select.preflight_owner(reduce(DataFrame.unionByName, marked, later.filter("id % 8 <> 0")), c, digest, SHARDS)


def edition_renewed(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the edition with the content of a later day; whether another selection was refused."""
    e = term_entries(spark, sf)
    c = edition(spark, sf, e)
    m = cut_lineage(contract.contract_of(c, EDITION_ROWS, SHARDS))
    later = e.withColumn("definition_zh", F.when(F.col("id") % 8 == 0, "新").otherwise(F.lit("中文"))).withColumn("definition", F.when(F.col("id") % 14 == 0, "found").otherwise(F.col("definition")))
    new = select.refresh(later, c, SHARDS, manifest=m)
    try:
        select.refresh(later, select.Candidate(c.entries, c.provenance.filter("id % 2 = 0"), c.queue), SHARDS, manifest=m)
        refused = False
    except MergeRefused:
        refused = True
    gaps = new.queue.select("id", F.array_join("gaps", "|").alias("gaps"), "owner")
    renewed = new.provenance.join(c.provenance.select("id", F.col("content_digest").alias("before")), "id").select("id", (F.col("content_digest") != F.col("before")).alias("renewed"))
    return new.entries.select("id", "frequency_rank", "definition_zh", F.lit(refused).alias("refused")).join(gaps, "id", "left").join(renewed, "id")


def raw_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Terms whose sources came as broken JSON, as an object, or as numbers."""
    k = F.col("id")
    text = F.when(k % 10 == 0, "not-json").when(k % 10 == 1, F.lit('{"a":1}')).when(k % 10 == 2, "[1, 2]").when(k % 10 == 3, "[]").when(k % 10 == 4, F.lit(None)).otherwise(F.to_json("sources"))
    return contract.malformed_sources(term_entries(spark, sf).withColumn("raw", text), "id", "raw")


def edition_ready(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the gate lets an edition pass: as selected with its gaps, after all are filled, and with a row too few."""
    e = term_entries(spark, sf)
    filled = e.withColumn("definition", F.coalesce(F.nullif("definition", F.lit("")), F.lit("filled"))).withColumn("definition_zh", F.lit("中文")).withColumn("pos", F.lit("noun"))
    whole, c = edition(spark, sf, filled), edition(spark, sf, e)
    cases = {"gaps": (c, e), "filled": (whole, filled), "short": (select.Candidate(whole.entries.filter("frequency_rank > 1"), whole.provenance.filter("selected_rank > 1"), whole.queue), filled)}
    out = []
    for name, (candidate, canonical) in cases.items():
        report, verdict = select.gate(candidate, canonical, EDITION_ROWS, SHARDS, EDITION_PHRASES)
        try:
            select.assert_ready(report, verdict)
            passed = True
        except MergeRefused:
            passed = False
        codes = report.agg(F.array_join(F.array_sort(F.collect_set("code")), "|").alias("codes"))
        out.append(codes.select(F.lit(name).alias("edition"), F.lit(passed).alias("passed"), F.lit(verdict["structural"]).alias("structural"), "codes"))
    return reduce(DataFrame.unionByName, out)


def published_edition(spark: SparkSession, sf: str) -> DataFrame:
    """The 300 most frequent terms published as a bundle and read again: rows and postings per field; whether a changed index was refused."""
    path, other = fresh_path(spark, "published"), fresh_path(spark, "published")
    e = term_entries(spark, sf).withColumn("frequency", 1_000_000.0 - F.col("id"))
    assemble.publish(e, 300, path)
    tables = assemble.published(spark, path)
    assemble.publish(e, 300, other)
    contract.entry_index(tables["entries"].filter("id > 1")).write.mode("overwrite").parquet(f"{other}/index")
    try:
        assemble.published(spark, other)
        refused = False
    except ValueError:
        refused = True
    clean = contract.index_violations(tables["entries"], tables["index"]).isEmpty()
    return tables["index"].groupBy("field").agg(F.countDistinct("id").alias("entries"), F.sum("n").alias("hits")).withColumns({"clean": F.lit(clean), "refused": F.lit(refused)})


def delta_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with the manifest of the queue's delta under another licence, with a short digest, with rows lost, or twice."""
    q = edition(spark, sf).queue
    good = q.agg(F.count("*").alias("n_rows")).withColumns({"licence": F.lit("CC BY-SA 4.0"), "source_digest": F.lit("0" * 64)})
    cases = {"good": (q, good), "licence": (q, good.withColumn("licence", F.lit("none"))), "digest": (q, good.withColumn("source_digest", F.lit("0a"))), "rows": (q.filter("id % 3 <> 0"), good), "twice": (q, good.unionByName(good))}
    return reduce(DataFrame.unionByName, [relations.check_delta_manifest(d, m, "CC BY-SA 4.0").select(F.lit(name).alias("manifest"), "code", "example") for name, (d, m) in cases.items()])


QUERIES = {f.__name__: f for f in (contract_manifest, contract_codes, index_codes, marked_preflight, edition_renewed, raw_sources, edition_ready, published_edition, delta_manifest)}

SQL = {
    "contract_manifest": f"""WITH {EDITION_SQL} SELECT 1 AS version, '{contract.POLICY}' AS policy, count(*) AS n_rows, count(*) FILTER (kind = 'word') AS n_words, count(*) FILTER (kind = 'phrase') AS n_phrases,
      (SELECT count(*) FROM q) AS n_queue, {SHARDS} AS shards, 64 AS digits, TRUE AS same FROM e""",
    "contract_codes": f"""WITH {EDITION_SQL}, n AS (SELECT count(*) FILTER (id % 3 = 0) AS p, (SELECT count(*) FROM q WHERE id % 3 = 0) AS q FROM e)
      SELECT change, code FROM n, (VALUES ('keys', 'selection_digest_mismatch', 'p'), ('keys', 'candidate_digest_mismatch', 'p'), ('content', 'candidate_digest_mismatch', 'p'), ('owners', 'repair_queue_digest_mismatch', 'q'),
        ('owners', 'candidate_digest_mismatch', 'q'), ('queue', 'repair_queue_count', 'q'), ('queue', 'repair_queue_digest_mismatch', 'q'), ('queue', 'candidate_digest_mismatch', 'q'), ('version', 'metadata', ''), ('counts', 'selection_counts', ''),
        ('digest', 'candidate_digest_mismatch', ''), ('twice', 'metadata', ''), ('lost', 'metadata', ''), ('lost', 'selection_counts', ''), ('lost', 'repair_queue_count', ''), ('lost', 'selection_digest_mismatch', ''), ('lost', 'repair_queue_digest_mismatch', ''),
        ('lost', 'candidate_digest_mismatch', ''), ('tables', 'missing_table:provenance', '')) t(change, code, needs) WHERE needs = '' OR needs = 'p' AND p > 0 OR needs = 'q' AND q > 0""",
    "index_codes": f"""WITH {EDITION_SQL}, s AS (SELECT count(*) AS n, count(*) FILTER (id % 10 <> 1) + count(*) FILTER (id % 15 = 0 AND id % 10 <> 1) AS m FROM e)
      SELECT 'fts_content_mismatch' AS code, CASE WHEN id % 10 = 1 THEN 'missing:' ELSE 'different:' END || id AS example FROM e WHERE id % 10 = 1 OR id % 6 = 0
      UNION ALL SELECT 'fts_content_mismatch', 'extra:' || (id + 1000000000) FROM e WHERE id % 15 = 0 AND id % 10 <> 1 UNION ALL SELECT 'fts_count', m || ' of ' || n FROM s WHERE n <> m""",
    "marked_preflight": f"""WITH {EDITION_SQL} SELECT CASE WHEN id % 29 = 0 THEN 'canonical_missing' ELSE 'canonical_content_mismatch' END AS code, CAST(id AS VARCHAR) AS example FROM g
      WHERE id % 29 = 0 OR (id % 8 = 0 AND NOT ((g1 OR g2 OR g3) AND id % 5 = 0))""",
    "edition_renewed": f"""WITH {EDITION_SQL}, x AS (SELECT *, g1 AND id % 14 <> 0 AS y1 FROM g)
      SELECT id, selected_rank AS frequency_rank, CASE WHEN id % 8 = 0 THEN '新' ELSE '中文' END AS definition_zh, TRUE AS refused, nullif(concat_ws('|', CASE WHEN y1 THEN 'definition' END, CASE WHEN g3 THEN 'pos' END), '') AS gaps,
        CASE WHEN y1 OR g3 THEN id % {SHARDS} END AS owner, id % 8 = 0 OR id % 9 = 0 OR id % 14 = 0 AS renewed FROM x""",
    "raw_sources": f"WITH {EDITION_SQL} SELECT 'malformed_source_json' AS code, CAST(k AS VARCHAR) AS example FROM t WHERE k % 10 IN (0, 1, 2, 4)",
    "edition_ready": f"""WITH {EDITION_SQL}, c AS (SELECT string_agg(code, '|' ORDER BY code) AS codes FROM (SELECT 'definition' AS code FROM g WHERE g1 UNION SELECT 'definition_zh' FROM g WHERE g2 UNION SELECT 'pos' FROM g WHERE g3))
      SELECT 'gaps' AS edition, FALSE AS passed, TRUE AS structural, codes FROM c UNION ALL SELECT 'filled', TRUE, TRUE, '' UNION ALL SELECT 'short', FALSE, FALSE, CASE WHEN (SELECT kind FROM e WHERE selected_rank = 1) = 'phrase' THEN 'rank_sequence|row_count|selection_counts' ELSE 'rank_sequence|row_count' END""",
    "published_edition": f"""WITH {EDITION_SQL}, p AS (SELECT * FROM t WHERE k <= 300), f AS (SELECT k, 'word' AS field, len(regexp_extract_all(term, '[\\p{{L}}\\p{{N}}]+')) AS n FROM p UNION ALL SELECT k, 'definition', 2 FROM p WHERE k % 7 <> 0 UNION ALL SELECT k, 'definition_zh', 1 FROM p WHERE k % 9 <> 0)
      SELECT field, count(*) AS entries, sum(n) AS hits, TRUE AS clean, TRUE AS refused FROM f GROUP BY field""",
    "delta_manifest": f"""WITH {EDITION_SQL}, n AS (SELECT count(*) FILTER (id % 3 <> 0) AS n FROM q) SELECT manifest, code, coalesce(example, CAST(n AS VARCHAR)) AS example FROM n,
      (VALUES ('licence', 'licence_mismatch', 'none'), ('digest', 'digest_malformed', '0a'), ('rows', 'row_count', NULL), ('twice', 'metadata', '2')) t(manifest, code, example)""",
}
