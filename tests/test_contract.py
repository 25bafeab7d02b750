"""The edition's contract, open JSON objects, digests of files and deltas, and rankings by tournament."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import TOOLS, entries
from wordlake.functions.overlay import put_members
from wordlake.operators import aggregates, rank
from wordlake.operators.sets import MergeRefused
from wordlake.plans import assemble, contract, enrich, select
from wordlake.sources import files, snapshots


def test_members_of_open_objects(spark):
    rows = [(1, '{"a":{"b":[1,2.5,null]},"put":"old","z":true}'), (2, "{}"), (3, None), (4, "broken"), (5, "[1]"), (6, '{"put":{"nested":1}}')]
    df = spark.createDataFrame(rows, "i int, j string").select("i", put_members(F.col("j"), {"put": F.lit('{"n":1}'), "more": F.lit('"x"')}).alias("j"))
    got = {r.i: json.loads(r.j) for r in df.collect()}
    new = {"put": {"n": 1}, "more": "x"}
    assert got == {1: {"a": {"b": [1, 2.5, None]}, "z": True} | new, **dict.fromkeys((2, 3, 4, 5, 6), new)}


def test_markers_of_repaired_rows(spark):
    """A queued row passes only with this candidate, its owner and the payload it has now."""
    e = entries(spark, *[(i, w, {"definition": "" if i % 2 else "A tool.", "enrichment": '{"tries":[1],"repairShardOwner":7}'}) for i, w in enumerate(TOOLS, 1)])
    c = select.select(e, 8, 0, 2)
    digest = contract.contract_of(c, 8, 2).first()["candidate_digest"]
    owner = F.pmod(F.col("id"), F.lit(2))
    fixed = e.withColumn("definition", F.lit("Found."))
    good = contract.with_marker(fixed, digest, owner)
    assert all(json.loads(r.enrichment)["tries"] == [1] for r in good.collect())
    codes = lambda df: sorted((r.code, r.example) for r in select.preflight_owner(df, c, digest, 2).collect())
    changed = [("canonical_content_mismatch", str(i)) for i in (2, 4, 6, 8)]  # not queued: no marker helps
    assert codes(good) == changed and codes(e) == []
    everyone = sorted(("canonical_content_mismatch", str(i)) for i in range(1, 9))
    for bad in (fixed, contract.with_marker(fixed, "another", owner), contract.with_marker(fixed, digest, owner + 1), good.withColumn("pos", F.lit("verb")), good.withColumn("enrichment", F.lit("broken"))):
        assert codes(bad) == everyone
    assert codes(good.filter("id > 1"))[-1] == ("canonical_missing", "1")


def test_refresh_refuses_another_selection(spark):
    e = entries(spark, *[(i, w, {}) for i, w in enumerate(TOOLS, 1)])
    c = select.select(e, 8, 0)
    m = contract.contract_of(c, 8, 1)
    assert select.refresh(e, c, manifest=m).entries.count() == 8
    with pytest.raises(MergeRefused, match="selection_digest_mismatch"):
        select.refresh(e, select.Candidate(c.entries, c.provenance.withColumn("canonical_rank", F.col("canonical_rank") + 1), c.queue), manifest=m)


def test_a_stale_and_a_missing_posting(spark):
    e = entries(spark, *[(i, w, {"examples": ["Use it well."]}) for i, w in enumerate(TOOLS, 1)])
    index = contract.entry_index(e)
    assert contract.index_violations(e, index.repartition(3)).collect() == []
    stale = index.withColumn("n", F.when((F.col("id") == 3) & (F.col("term") == "well"), F.col("n") + 1).otherwise(F.col("n"))).filter("not (id = 5 and term = 'well')").filter("id <> 7")
    assert sorted((r.code, r.example) for r in contract.index_violations(e, stale).collect()) == [("fts_content_mismatch", "different:3"), ("fts_content_mismatch", "different:5"), ("fts_content_mismatch", "missing:7"), ("fts_count", "7 of 8")]


def test_changed_rows_and_bytes_are_refused(spark, tmp_path):
    e = entries(spark, *[(i, w, {}) for i, w in enumerate(TOOLS, 1)])
    snapshots.write_delta(e, str(tmp_path / "d"), "abc", "CC0")
    assert snapshots.read_delta(spark, str(tmp_path / "d")).count() == 8
    e.withColumn("pos", F.when(F.col("id") == 3, "verb").otherwise(F.col("pos"))).write.mode("overwrite").parquet(str(tmp_path / "d" / "rows"))
    with pytest.raises(ValueError, match="does not fit"):
        snapshots.read_delta(spark, str(tmp_path / "d"))
    page = '<?xml version="1.0"?><LexicalResource><Lexicon id="x" version="1"><LexicalEntry id="e1"><Lemma writtenForm="rasp" partOfSpeech="n"/><Sense id="s1" synset="y1"/></LexicalEntry><Synset id="y1"><Definition>A tool.</Definition></Synset></Lexicon></LexicalResource>'
    for name, text in (("a.xml", page), ("b.xml", page.replace("tool", "took"))):
        (tmp_path / name).write_text(text)
    digest = files.file_digest(spark, str(tmp_path / "a.xml"))
    assert files.read_wordnet_xml(spark, str(tmp_path / "a.xml"), {"id": "x", "version": "1"}, digest).entries.count() == 1
    with pytest.raises(ValueError, match="another file"):
        files.read_wordnet_xml(spark, str(tmp_path / "b.xml"), digest=digest)
    with pytest.raises(ValueError, match="another release"):
        files.read_wordnet_xml(spark, str(tmp_path / "a.xml"), {"id": "x", "version": "2"}, digest)


def test_tournament_of_many_shares(spark):
    """A thousand shares meet sixteen at a time, so no window holds more than its share or sixteen times the limit."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 5 == 0, "phrase").otherwise("word").alias("kind"), (F.col("id") * 7919 % 3001).alias("v"))
    got = {(r.kind, r.stream_rank): r.id for r in rank.stream_rank(df, "kind", [F.col("v"), F.col("id")], 40, shares=1000).collect()}
    for kind in ("word", "phrase"):
        ids = sorted((i for i in range(3000) if (i % 5 == 0) == (kind == "phrase")), key=lambda i: (i * 7919 % 3001, i))
        assert [got[kind, n + 1] for n in range(40)] == ids[:40]
    plan = rank.stream_rank(df, "kind", [F.col("v")], 40, shares=1000)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number()") == 4


def test_senses_are_merged_once(spark):
    """At most 40 new ones, none twice, open keys kept."""
    rng = random.Random(2)
    sense = lambda n: (f"y{n}", "rasp", "n")
    rows = [("rasp", (n, "e", f"s{n}"), "oewn", *sense(n % 50)) for n in range(70)]
    rng.shuffle(rows)
    s = spark.createDataFrame(rows, "key string, place struct<sense_order:int,entry_id:string,sense_id:string>, source string, synset string, form string, pos string")
    value = F.struct(F.col("pos"), F.array(F.lit("d")).alias("definitions"), F.lit(None).cast("array<string>").alias("sense_ids"), F.lit(None).cast("map<string,array<string>>").alias("relations"), F.lit(None).cast("map<string,array<string>>").alias("relation_sources"), F.to_json(F.struct("source", "synset", F.col("form").alias("writtenForm"))).alias("extra"))
    e = entries(spark, (1, "rasp", {"senses": [("n", ["own"], None, None, None, '{"source":"oewn","synset":"y3","writtenForm":"rasp","mine":{"k":[1]}}')]}), (2, "vice", {}))
    out = assemble.apply_senses(e, s.withColumn("sense", value))
    got = {r.id: [json.loads(x.extra) for x in r.senses] for r in out.collect()}
    assert [x["synset"] for x in got[1]] == ["y3", *(f"y{n}" for n in range(41) if n != 3)] and got[1][0]["mine"] == {"k": [1]} and got[2] == []


def test_needs_come_from_what_a_row_lacks(spark):
    full = {"synonyms": ["a"], "antonyms": ["b"], "related_words": ["c"], "phrases": ["d"], "examples": ["e"]}
    rows = entries(spark, (1, "rasp", {**full, "pos": ""}), (2, "vice", {**full, "us_phonetic": "", "antonyms": []}), (3, "hand saw", {**full, "us_phonetic": "", "pos": ""}), (4, "mallet", {**full, "frequency": 999.0}), (5, "sander", {**full, "definition_zh": ""}), (6, "pliers", {**full, "examples": []}))
    needs = {r.term: {c for c, v in r.asDict().items() if v is True} for r in enrich.plan_needs(rows.withColumn("term", F.col("word")), deep=True).collect()}
    assert needs == {"rasp": {"pos", "network"}, "vice": {"us_phonetic", "antonyms", "relations", "network"}, "hand saw": set(), "mallet": {"frequency", "network"}, "sander": {"translation"}, "pliers": {"examples", "network"}}
    repair = {r.term: {c for c, v in r.asDict().items() if v is True} for r in enrich.plan_needs(rows.withColumn("term", F.col("word")), deep=True, repair_only=True).collect()}
    assert repair == {t: n - {"antonyms", "relations", "frequency", "examples"} if t in ("rasp", "vice") else n - {"frequency", "examples", "network"} for t, n in needs.items()}


def test_staleness_of_an_empty_state(spark):
    state = spark.createDataFrame([], "user_id long, ts timestamp, status string")
    row = aggregates.staleness(state, ["user_id"], "ts", F.current_timestamp(), 10).first()
    assert row.stale and row.stale_seconds is None
