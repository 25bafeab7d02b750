"""The contract of an edition: chained digests of its tables, markers of repaired rows, and its stored index.

The manifest's candidate digest covers the digests of the selection, of the content it was selected
with, and of the repair queue with its owners; so a reader that recomputes the three tells which
table has changed, and a repaired row can name the candidate that it was repaired for.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlake.functions.digest import row_digest, table_digest
from wordlake.functions.overlay import put_members
from wordlake.operators.joins import index_diff
from wordlake.operators.lookup import build_index
from wordlake.schema import PAYLOAD

if TYPE_CHECKING:
    from wordlake.plans.select import Candidate

# The contract's version and policy, the tables of a bundle, the keys of a repair's marker, the indexed fields.
VERSION, POLICY = 1, "bounded-dictionary-evidence"
TABLES = ["entries", "provenance", "queue"]
MARKER = {"digest": "repairCandidateDigest", "owner": "repairShardOwner", "payload": "repairPayloadDigest"}
INDEXED = ["word", "definition", "definition_zh", "examples", "phrases"]


def json_digest(names: list[str]) -> Column:
    """Row digest over columns of any type, in their JSON form."""
    return row_digest(*[F.to_json(F.struct(c)) for c in names])


def digest_of(df: DataFrame, order: str, digest: Column) -> DataFrame:
    """One row: ``digest`` over all rows in order, by levels of buckets."""
    return table_digest(df.withColumn("__d", digest), order, F.col("__d")).select("digest")


def selection_digest(provenance: DataFrame) -> DataFrame:
    """Which rows were selected, at which places, of which identity."""
    return digest_of(provenance, "selected_rank", json_digest(["id", "kind", "term_key", "evidence", "canonical_rank", "identity_digest"]))


def baseline_digest(provenance: DataFrame) -> DataFrame:
    """The content that the rows were selected with."""
    return digest_of(provenance, "selected_rank", json_digest(["id", "content_digest"]))


def queue_digest(queue: DataFrame) -> DataFrame:
    """The rows to be repaired, their gaps and owners."""
    return digest_of(queue, "id", json_digest(["id", "frequency_rank", "owner", "gaps"]))


def chained(shards: Column) -> Column:
    """The candidate digest over the three table digests."""
    parts = [F.lit(VERSION), F.lit(POLICY), shards, *[F.coalesce(c, F.lit("")) for c in ("selection_digest", "baseline_digest", "queue_digest")]]
    return row_digest(*parts)


def table_digests(candidate: Candidate) -> DataFrame:
    """One row: selection_digest, baseline_digest, queue_digest as the tables are now."""
    parts = {"selection_digest": selection_digest(candidate.provenance), "baseline_digest": baseline_digest(candidate.provenance), "queue_digest": queue_digest(candidate.queue)}
    return reduce(lambda a, b: a.join(F.broadcast(b)), [d.withColumnRenamed("digest", name) for name, d in parts.items()])  # one row each


def contract_of(candidate: Candidate, limit: int, shards: int) -> DataFrame:
    """The edition's manifest: version, policy, sizes and chained digests."""
    p = candidate.provenance.agg(F.count("*").alias("n_rows"), F.count_if(F.col("kind") == "word").alias("n_words"), F.count_if(F.col("kind") == "phrase").alias("n_phrases"))
    sizes = p.join(F.broadcast(candidate.queue.agg(F.count("*").alias("n_queue"))))
    about = {"version": F.lit(VERSION), "policy": F.lit(POLICY), "expected_rows": F.lit(limit), "shards": F.lit(shards)}
    return sizes.join(F.broadcast(table_digests(candidate))).withColumns(about).withColumn("candidate_digest", chained(F.col("shards")))


def contract_violations(candidate: Candidate, manifest: DataFrame, expected_queue: DataFrame, limit: int) -> DataFrame:
    """(code, example): a manifest that is missing, of another policy, or not that of these tables.

    ``expected_queue`` are the rows that the entries' gaps ask for.
    """
    one = manifest.agg(F.count("*").alias("rows"), *[F.min(c).alias(c) for c in manifest.columns])
    fits = (F.col("rows") == 1) & (F.col("version") == VERSION) & (F.col("policy") == POLICY) & (F.col("expected_rows") == limit) & (F.col("shards") > 0)
    counts = candidate.provenance.agg(F.count_if(F.col("kind") == "word").alias("words_now"), F.count_if(F.col("kind") == "phrase").alias("phrases_now"))
    queue = candidate.queue.agg(F.count("*").alias("queue_size")).join(F.broadcast(expected_queue.agg(F.count("*").alias("queue_due"))))
    now = table_digests(candidate).withColumnsRenamed({f"{x}_digest": f"{x}_now" for x in ("selection", "baseline", "queue")})
    rows = one.join(F.broadcast(counts)).join(F.broadcast(queue)).join(F.broadcast(now))
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    broken = differs("selection_digest", "selection_now") | differs("baseline_digest", "baseline_now") | differs("queue_digest", "queue_now") | ~F.col("candidate_digest").eqNullSafe(chained(F.col("shards")))
    codes = F.array(
        F.when(~F.coalesce(fits, F.lit(False)), F.struct(F.lit("metadata").alias("code"), F.col("rows").cast("string").alias("example"))),
        F.when(differs("n_words", "words_now") | differs("n_phrases", "phrases_now"), F.struct(F.lit("selection_counts").alias("code"), F.col("phrases_now").cast("string").alias("example"))),
        F.when(differs("n_queue", "queue_size") | differs("queue_size", "queue_due"), F.struct(F.lit("repair_queue_count").alias("code"), F.col("queue_size").cast("string").alias("example"))),
        F.when(differs("selection_digest", "selection_now"), F.struct(F.lit("selection_digest_mismatch").alias("code"), F.col("selection_now").alias("example"))),
        F.when(differs("queue_digest", "queue_now"), F.struct(F.lit("repair_queue_digest_mismatch").alias("code"), F.col("queue_now").alias("example"))),
        F.when(broken, F.struct(F.lit("candidate_digest_mismatch").alias("code"), F.col("candidate_digest").alias("example"))),
    )
    return rows.select(F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("c")).select("c.code", "c.example")


def missing_tables(spark_tables: dict[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """(code, example): tables that the contract asks for and the bundle lacks."""
    lost = [t for t in TABLES if t not in spark_tables]
    return manifest.limit(1).select(F.explode(F.array(*[F.lit(t) for t in lost]).cast("array<string>")).alias("example")).select(F.lit("missing_table").alias("code"), "example")


def malformed_sources(raw: DataFrame, id_col: str, sources: str) -> DataFrame:
    """(code, example): rows whose sources, as JSON text, are no array of strings."""
    kind = F.schema_of_variant(F.try_parse_json(F.col(sources)))
    fine = F.coalesce(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(False))
    return raw.filter(~fine).select(F.lit("malformed_source_json").alias("code"), F.col(id_col).cast("string").alias("example"))


# --- markers


def payload_digest() -> Column:
    return json_digest(["id", *PAYLOAD])


def with_marker(entries: DataFrame, candidate_digest: str, owner: Column) -> DataFrame:
    """Entries whose ``enrichment`` names the candidate, the owner and the payload they were repaired for; its other keys stay."""
    said = {MARKER["digest"]: F.lit(json.dumps(candidate_digest)), MARKER["owner"]: owner.cast("string"), MARKER["payload"]: F.concat(F.lit('"'), payload_digest(), F.lit('"'))}
    return entries.withColumn("enrichment", put_members(F.col("enrichment"), said))


def marker_fits(candidate_digest: str, owner: Column) -> Column:
    """Whether a row's marker names this candidate, this owner and the row's payload as it is."""
    said = lambda key: F.get_json_object("enrichment", f"$.{MARKER[key]}")
    valid = F.try_parse_json("enrichment").isNotNull()
    fits = (said("digest") == candidate_digest) & (said("owner").try_cast("int") == owner) & (said("payload") == payload_digest())
    return F.coalesce(valid & fits, F.lit(False))


# --- the stored index


def entry_index(entries: DataFrame) -> DataFrame:
    """Postings of the indexed fields of all entries."""
    return build_index(entries.select("id", *INDEXED), "id", INDEXED)


def posting_digests(index: DataFrame) -> DataFrame:
    """id, digest: over the entry's postings, whatever their order; nothing is gathered."""
    h = lambda seed: F.xxhash64("term", "field", "n", "first_pos", F.lit(seed))
    per = index.groupBy("id").agg(F.count("*").alias("n"), F.sum(h(1).cast("decimal(38,0)")).alias("a"), F.bit_xor(h(2)).alias("b"), F.sum(h(3).cast("decimal(38,0)")).alias("c"))
    return per.select("id", row_digest(F.col("n"), F.col("a"), F.col("b"), F.col("c")).alias("digest"))


def index_violations(entries: DataFrame, index: DataFrame) -> DataFrame:
    """(code, example): entries whose postings the stored index lacks, has too many of, or has otherwise."""
    expected, stored = posting_digests(entry_index(entries)), posting_digests(index)
    wrong = index_diff(expected, stored, "id", ["digest"])
    sizes = expected.agg(F.count("*").alias("n")).join(F.broadcast(stored.agg(F.count("*").alias("m")))).filter("n <> m").select(F.lit("fts_count").alias("code"), F.concat_ws(" of ", "m", "n").alias("example"))
    return sizes.unionByName(wrong.select(F.lit("fts_content_mismatch").alias("code"), F.concat_ws(":", "kind", "id").alias("example")))
