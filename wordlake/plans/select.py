"""Selection of a bounded edition, its quality gate, refreshes and repair deltas."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlake.functions.normalize import is_phrase, is_phrase_of, lexical_reason, lexical_reason_of, nfkc, norm_key, phrase_evidence, phrase_evidence_of, phrase_names, pos_names, quality_gaps, shard_filter
from wordlake.operators.aggregates import check_dense_rank, check_unique, issue_rollup
from wordlake.operators.joins import index_diff
from wordlake.operators.lineage import cut_lineage
from wordlake.operators.rank import choose_counts, interleave, order_breaks, stream_rank
from wordlake.operators.sets import MergeRefused, check_exact_union, three_way
from wordlake.plans import contract
from wordlake.plans.contract import json_digest as text_digest
from wordlake.schema import CONTRACT_IDENTITY, MUTABLE, PAYLOAD

# Gaps that a repair may fill, what each gap allows to change, the least words of the large edition.
REPAIRABLE = ["definition", "definition_zh", "pos", "phonetic", "phonetic_unreliable"]
GAP_COLUMNS = {"definition": ["definition"], "definition_zh": ["definition_zh"], "pos": ["pos"], "phonetic": ["us_phonetic", "uk_phonetic"]}
LARGE_EDITION, LARGE_EDITION_WORDS = 20_000, 15_000


@dataclass
class Candidate:
    """A selected edition: its entries, their provenance, and the rows still to be repaired."""

    entries: DataFrame
    provenance: DataFrame
    queue: DataFrame


def of_edition(rows: DataFrame, edition: DataFrame) -> DataFrame:
    """The rows whose ids a table of an edition holds.  An edition is bounded (20,000 rows), so its ids are broadcast and digests are made of its rows only."""
    return rows.join(F.broadcast(edition.select("id").distinct()), "id", "left_semi")


def gaps_of(columns: str = "word definition definition_zh us_phonetic uk_phonetic pos") -> Column:
    return quality_gaps(*[F.col(c) for c in columns.split()])


def candidate_pool(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows fit for selection with kind, key and evidence; refused rows with their reason).

    What several rules ask of a row is worked out once, and every rule before the rows are dealt by
    key: a filter on the reason ahead of that would make Spark work it all out twice.
    """
    flag = lambda path: F.get_json_object("scope", path)
    rows = entries.filter(F.col("frequency_rank").isNotNull()).withColumns({"__key": norm_key(F.col("word")), "__names": pos_names(F.col("pos")), "__dump": flag("$.kaikki"), "__list": flag("$.ecdictOxfordFlag")})
    # of ASCII the term key is the normalized key: only other texts go to Python
    ascii_ = F.col("word").rlike(r"\A[\x00-\x7F]*\z")
    rows = rows.withColumns({"term_key": F.coalesce(F.when(ascii_, F.col("__key")), norm_key(nfkc(F.when(~ascii_, F.col("word"))))), "__named": phrase_names(F.col("__names"))}).withColumn("__phrase", is_phrase_of(F.col("__key"), F.col("__named")))
    lexical = lexical_reason_of(F.col("term_key"), F.col("__names"), F.col("sources"), F.col("__dump"), F.col("__list"))
    rows = rows.withColumn("evidence", phrase_evidence_of(F.col("__phrase"), F.col("__named"), F.col("sources"), F.col("__dump"), F.col("__list")))
    reason = (
        F.when(F.size(F.coalesce("sources", F.array().cast("array<string>"))) == 0, "missing_source_provenance")
        .when(F.coalesce("scope", F.lit("{}")).rlike(r"^\s*\{") != True, "malformed_scope_json")  # noqa: E712
        .when(F.col("__key") != F.col("normalized_word"), "normalized_word_mismatch")
        .otherwise(F.coalesce(lexical, F.when(F.col("evidence").isNull(), "phrase_evidence_insufficient")))
    )
    judged = rows.withColumn("reason", reason).withColumn("kind", F.when(F.col("__phrase"), "phrase").otherwise("word")).drop("__key", "__names", "__dump", "__list", "__named", "__phrase")
    # refused rows stand alone, so that many of one key are no hot task
    alone = F.when(F.col("reason").isNotNull(), F.col("id"))
    placed = judged.withColumn("__n", F.row_number().over(Window.partitionBy("term_key", alone).orderBy("frequency_rank", "id")))
    pool = placed.filter("__n = 1").filter("reason is null").select(*entries.columns, "term_key", "evidence", "kind")
    refused = placed.select("id", "word", F.coalesce("reason", F.when(F.col("__n") > 1, "duplicate_term_key")).alias("reason")).filter("reason is not null")
    return pool, refused


def repair_queue(entries: DataFrame, shards: int) -> DataFrame:
    """Rows with gaps: id, selected rank, owner = id modulo shards, gaps in order."""
    rows = entries.withColumn("gaps", gaps_of())
    return rows.filter(F.size("gaps") > 0).select("id", "frequency_rank", F.pmod(F.col("id"), F.lit(shards)).cast("int").alias("owner"), "gaps")


def first_of_kinds(entries: DataFrame | Callable[[int | None], DataFrame], limit: int, reach: int | None = None) -> DataFrame:
    """The first ``limit`` rows of each kind of the pool with their ``stream_rank``, stored.

    Rows are judged in order of rank, and no further than is needed: neither a row's verdict nor which
    row of a term key counts depends on rows of higher ranks.  While one of the kinds is short, sixteen times as
    many ranks are judged, in the end all.  Of a function of the reach no more is asked for either: it
    gives all rows up to that rank at least, and all there are for None.
    """
    given = entries if callable(entries) else lambda _: entries
    reach, last = reach or 16 * limit, None
    while True:
        whole = last is not None and reach >= last
        some = given(None) if whole else given(reach).filter(F.col("frequency_rank") <= reach)
        ranked = cut_lineage(stream_rank(candidate_pool(some)[0], "kind", [F.col("frequency_rank"), F.col("id")], limit))
        full = ranked.groupBy("kind").count().filter(F.col("count") >= limit).count() == 2
        if full or whole:
            return ranked
        last = last or given(None).agg(F.max("frequency_rank")).first()[0] or 0
        reach *= 16


def select(entries: DataFrame | Callable[[int | None], DataFrame], limit: int, phrase_target: int, shards: int = 1) -> Candidate:
    """The edition of ``limit`` rows: phrases spread evenly among words, both in rank order.

    ``entries`` may be a function, as ``first_of_kinds`` takes it.
    """
    # at most ``limit`` rows of each kind; counts, rows and provenance are taken from them
    ranked = first_of_kinds(entries, limit)
    counts = {r[0]: r[1] for r in ranked.groupBy("kind").count().collect()}
    words, phrases = choose_counts(limit, phrase_target, counts.get("word", 0), counts.get("phrase", 0), LARGE_EDITION_WORDS if limit == LARGE_EDITION else 0)
    chosen = interleave(ranked, F.col("kind") == "phrase", words + phrases, phrases)
    digests = [text_digest(CONTRACT_IDENTITY).alias("identity_digest"), text_digest(["id", *PAYLOAD]).alias("content_digest")]
    provenance = chosen.select("id", "selected_rank", "kind", "term_key", "evidence", F.col("frequency_rank").alias("canonical_rank"), *digests)
    rows = chosen.withColumn("frequency_rank", F.col("selected_rank").cast("int")).drop("selected_rank", "stream_rank", "term_key", "evidence", "kind")
    return Candidate(rows, provenance, repair_queue(rows, shards))


def with_provenance(entries: DataFrame, provenance: DataFrame) -> DataFrame:
    """Entries with what is known of their selection; nulls where nothing is."""
    return entries.join(provenance.select(F.col("id").alias("__p"), "selected_rank", "kind", "term_key", "evidence", "canonical_rank", "identity_digest", "content_digest"), F.col("id") == F.col("__p"), "left")


def with_queue_flag(provenance: DataFrame, queue: DataFrame) -> DataFrame:
    """Provenance with ``queued``: whether the row waits for a repair."""
    return provenance.join(queue.select("id", F.lit(True).alias("queued")).distinct(), "id", "left").withColumn("queued", F.coalesce("queued", F.lit(False)))


def say(df: DataFrame, code: str) -> DataFrame:
    """(code, example) rows for the rows of df."""
    return df.select(F.lit(code).alias("code"), F.col("id").cast("string").alias("example"))


def internal_violations(candidate: Candidate, limit: int, shards: int = 1, phrases: int | None = None) -> DataFrame:
    """(code, example) rows of what the edition's own tables say against it: no canonical rows needed."""
    e, p, q = candidate.entries, candidate.provenance, candidate.queue
    both = with_provenance(e, p)
    counts = e.agg(F.count("*").alias("n")).filter(F.col("n") != limit).select(F.lit("row_count").alias("code"), F.col("n").cast("string").alias("example"))
    gaps = e.select("id", F.explode(gaps_of()).alias("code")).select("code", F.col("id").cast("string").alias("example"))
    expected = repair_queue(e, shards)
    queue = index_diff(expected, q, "id", ["frequency_rank", "gaps"])
    owners = q.filter(F.col("owner") != F.pmod(F.col("id"), F.lit(shards)))
    flag = lambda path: F.get_json_object("scope", path)
    key = norm_key(F.col("word"), "term_key")
    lexical = lexical_reason(key, F.col("pos"), F.col("sources"), flag("$.kaikki"), flag("$.ecdictOxfordFlag"))
    evidence = phrase_evidence(F.col("word"), F.col("pos"), F.col("sources"), flag("$.kaikki"), flag("$.ecdictOxfordFlag"))
    declared = p.agg(F.count_if(F.col("kind") == "phrase").alias("n")).filter(F.col("n") != F.lit(phrases)).select(F.lit("selection_counts").alias("code"), F.col("n").cast("string").alias("example"))
    few = p.agg(F.count_if(F.col("kind") == "word").alias("n")).filter((F.lit(limit) == LARGE_EDITION) & (F.col("n") < LARGE_EDITION_WORDS)).select(F.lit("minimum_word_count").alias("code"), F.col("n").cast("string").alias("example"))
    json = lambda c: F.coalesce(F.try_parse_json(F.coalesce(c, F.lit("{}"))).isNull(), F.lit(True))
    parts = [
        counts,
        declared,
        few,
        say(e.filter(json("scope") | json("enrichment")), "malformed_json"),
        say(e.filter(lexical.isNotNull()), "lexical_policy"),
        say(both.filter(F.coalesce("evidence", F.lit("?")) != F.coalesce(evidence, F.lit("?"))), "phrase_evidence"),
        say(p.join(e.select("id"), "id", "left_anti"), "provenance_count"),
        say(both.filter(text_digest(["id", *PAYLOAD]) != F.col("content_digest")), "candidate_digest_mismatch"),
        check_dense_rank(e, "frequency_rank"),
        check_unique(e, ["id", "normalized_word"]),
        say(both.filter("__p is null"), "provenance_count"),
        say(both.filter("selected_rank <> frequency_rank"), "ranking_policy"),
        say(both.filter(norm_key(F.col("word")) != F.col("normalized_word")), "normalized_word_mismatch"),
        say(both.filter(norm_key(F.col("word"), "term_key") != F.col("term_key")), "term_key_mismatch"),
        say(both.filter((F.col("kind") == "phrase") != is_phrase(F.col("word"), F.col("pos"))), "phrase_evidence"),
        say(e.filter(F.size(F.coalesce("sources", F.array().cast("array<string>"))) == 0), "missing_source_provenance"),
        say(order_breaks(p, "kind", "selected_rank", "canonical_rank"), "stream_order"),
        say(queue, "repair_queue_mismatch"),
        say(owners, "shard_owner_mismatch"),
        gaps,
    ]
    return reduce(DataFrame.unionByName, parts)


def violations(candidate: Candidate, canonical: DataFrame, limit: int, shards: int = 1, phrases: int | None = None) -> DataFrame:
    """(code, example) rows of everything that breaks the edition's contract with the canonical rows."""
    now = of_edition(canonical, candidate.provenance).select("id", F.col("frequency_rank").alias("rank_now"), text_digest(CONTRACT_IDENTITY).alias("identity_now"), text_digest(["id", *PAYLOAD]).alias("content_now"))
    against = candidate.provenance.join(now, "id", "left")
    parts = [
        internal_violations(candidate, limit, shards, phrases),
        say(against.filter("identity_now is null"), "canonical_missing"),
        say(against.filter("identity_now <> identity_digest"), "canonical_identity_mismatch"),
        say(against.filter("content_now <> content_digest"), "canonical_content_mismatch"),
    ]
    return reduce(DataFrame.unionByName, parts)


def assert_ready(report: DataFrame, verdict: dict) -> None:
    """Raise, with the report, unless the gate found the edition ready."""
    if not verdict["ready"]:
        raise MergeRefused("not ready: " + ", ".join(f"{r['code']} {r['n']}" for r in report.orderBy("code").collect()))


def gate(candidate: Candidate, canonical: DataFrame, limit: int, shards: int = 1, phrases: int | None = None) -> tuple[DataFrame, dict]:
    """(issue counts with examples, {structural, ready}): structural if only repairable issues remain."""
    report = cut_lineage(issue_rollup(violations(candidate, canonical, limit, shards, phrases)))
    codes = {r["code"] for r in report.select("code").collect()}
    structural = not codes - set(REPAIRABLE)
    return report, {"structural": structural, "ready": structural and not codes}


def backfilled_beyond(candidate: Candidate, limit: int) -> DataFrame:
    """One row: how many selected rows rank beyond ``limit`` among all entries."""
    return candidate.provenance.agg(F.count_if(F.col("canonical_rank") > limit).alias("backfilled"))


def refresh(canonical: DataFrame, template: Candidate, shards: int = 1, owner: int | None = None, manifest: DataFrame | None = None) -> Candidate:
    """The edition's rows with the canonical content of now; ids, ranks, kinds and keys stay.

    With ``owner`` only its rows are renewed.  Refused if a row's identity has changed, or if the
    template's selection is not that of ``manifest``.
    """
    p = template.provenance
    if manifest is not None:
        declared = {r[0] for r in manifest.select("selection_digest").limit(2).collect()}
        if declared != {contract.selection_digest(p).first()[0]}:
            raise MergeRefused("selection_digest_mismatch: the template is another selection")
    mine = F.lit(True) if owner is None else F.pmod(F.col("id"), F.lit(shards)) == owner
    canonical = of_edition(canonical, p)
    now = canonical.withColumn("identity_now", text_digest(CONTRACT_IDENTITY))
    due = p.filter(mine).select("id", "selected_rank", "identity_digest")
    found = due.join(now, "id", "left")
    if found.filter("identity_now is null or identity_now <> identity_digest").limit(1).count():
        raise MergeRefused("a selected row has lost its identity")
    rows = found.withColumn("frequency_rank", F.col("selected_rank").cast("int")).select(*template.entries.columns)
    if owner is not None:
        rows = rows.unionByName(template.entries.filter(~mine))
    digests = canonical.select("id", text_digest(["id", *PAYLOAD]).alias("content_now"))
    renewed = p.join(digests, "id", "left").withColumn("content_digest", F.when(mine, F.col("content_now")).otherwise(F.col("content_digest"))).drop("content_now")
    return Candidate(rows, renewed, repair_queue(rows, shards))


def preflight_owner(entries: DataFrame, candidate: Candidate, candidate_digest: str, shards: int, owner: int | None = None) -> DataFrame:
    """(code, example): rows of an owner (of all, if none is named) that are gone, or differ from the baseline for no good reason.

    A row may differ only if it is queued and its marker names this candidate, its owner and the
    payload that it has now.
    """
    of = F.pmod(F.col("id"), F.lit(shards))
    mine = candidate.provenance if owner is None else candidate.provenance.filter(of == owner)
    p = with_queue_flag(mine.select("id", "content_digest"), candidate.queue)
    now = of_edition(entries, mine).select("id", text_digest(["id", *PAYLOAD]).alias("content_now"), contract.marker_fits(candidate_digest, of).alias("marked"))
    joined = p.join(now, "id", "left")
    code = F.when(F.col("content_now").isNull(), "canonical_missing").when((F.col("content_now") != F.col("content_digest")) & ~(F.col("queued") & F.col("marked")), "canonical_content_mismatch")
    return joined.select(code.alias("code"), F.col("id").cast("string").alias("example")).filter("code is not null")


def allowed_columns() -> Column:
    """The columns that a queue row's gaps allow to change."""
    each = [F.when(F.array_contains("gaps", g), F.array(*[F.lit(c) for c in cols])).otherwise(F.array().cast("array<string>")) for g, cols in GAP_COLUMNS.items()]
    return F.concat(*each)


def export_repair(entries: DataFrame, candidate: Candidate, owner: int, shards: int) -> DataFrame:
    """The owner's repaired rows: id, owner, payload and the columns changed; refused while gaps remain."""
    queue = candidate.queue.filter(F.col("owner") == owner).select("id", "gaps")
    base = candidate.entries.select("id", F.struct(*PAYLOAD).alias("b"))
    joined = of_edition(entries, queue).join(queue, "id").join(base, "id")
    if joined.filter(F.size(gaps_of()) > 0).limit(1).count():
        raise MergeRefused("rows of the queue still have gaps")
    changed = F.filter(F.array(*[F.when(~F.to_json(F.struct(F.col(c).alias("v"))).eqNullSafe(F.to_json(F.struct(F.col(f"b.{c}").alias("v")))), c) for c in PAYLOAD]), lambda c: c.isNotNull())
    return joined.select("id", F.lit(owner).alias("owner"), *PAYLOAD, F.array_intersect(changed, allowed_columns()).alias("changed_columns"))


def check_union(candidate: Candidate, deltas: DataFrame, shards: int) -> DataFrame:
    """(code, example): deltas that are no exact union of the queue, or leave gaps."""
    union = check_exact_union(candidate.queue, deltas, "id", "owner", shards)
    d = deltas.join(candidate.entries.select("id", "word"), "id")
    left = d.filter(F.size(gaps_of()) > 0).select(F.lit("gap_left").alias("code"), F.col("id").cast("string").alias("example"))
    return union.unionByName(left)


def apply_union(canonical: DataFrame, candidate: Candidate, deltas: DataFrame, shards: int) -> DataFrame:
    """Canonical rows with the deltas' changed columns; refused on any violation or conflict."""
    if bad := check_union(candidate, deltas, shards).limit(5).collect():
        raise MergeRefused(f"deltas refused: {bad}")
    merged = three_way(candidate.entries, deltas, canonical, "id", PAYLOAD)
    if merged.filter(F.size("conflicts") > 0).limit(1).count():
        raise MergeRefused("three-way conflict")
    return merged.drop("conflicts")


def export_shard(entries: DataFrame, i: int, n: int, rank_cap: int | None = None) -> DataFrame:
    """The id and the columns that enrichment may change, of contiguous shard ``i`` of ``n``."""
    return shard_filter(entries, "id", i, n, rank_cap=rank_cap).select("id", *MUTABLE)


def export_if_ready(entries: DataFrame, finished: Column, columns: list[str]) -> tuple[str, DataFrame | None]:
    """('ready', rows) once every row is finished, else ('waiting finished=f total=t', None)."""
    total, done = entries.agg(F.count("*"), F.count_if(finished)).first()
    if done < total:
        return f"waiting finished={done} total={total}", None
    return "ready", entries.select("id", *columns)
