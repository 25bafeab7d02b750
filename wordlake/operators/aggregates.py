"""Aggregates: dedupe, coverage, histograms, checks and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: list[str], order: Column, keep: str = "first", length_of: Column | None = None) -> DataFrame:
    """One row per key: the first in order, or the first of the longest.

    The choice is an aggregate with map-side combine, so a hot key is no hot task.
    """
    best = F.struct((-length_of if keep == "longest" else F.lit(0)).alias("a"), order.alias("b"))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), best).alias("__row")).select(*keys, "__row.*")


def coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row: rows in all and, per field, rows in which it says something."""
    says = lambda c: ~F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).isin("", "[]", "{}")
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(says(c)).alias(c) for c in fields])


def status_histogram(df: DataFrame, json_col: str, path: str = "$.status", default: str = "pending") -> DataFrame:
    """Rows per value at a JSON path."""
    return df.groupBy(F.coalesce(F.get_json_object(json_col, path), F.lit(default)).alias("status")).agg(F.count("*").alias("n"))


def issue_rollup(violations: DataFrame, examples: int = 20) -> DataFrame:
    """Per code: how many, and its first examples.

    Counts are partial aggregates; examples are cut to the first of each code before they are
    gathered.
    """
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("code").orderBy("example"))
    firsts = violations.withColumn("n", n).filter(F.col("n") <= examples).groupBy("code").agg(F.array_sort(F.collect_list("example")).alias("examples"))
    return violations.groupBy("code").agg(F.count("*").alias("n")).join(firsts, "code")


def check_dense_rank(df: DataFrame, rank: str) -> DataFrame:
    """One row (code, example) if the ranks are not 1..n, each once."""
    s = df.agg(F.min(rank).alias("low"), F.max(rank).alias("high"), F.countDistinct(rank).alias("n"), F.count("*").alias("all"))
    bad = s.filter("not (n = all and (all = 0 or low = 1 and high = n))")
    return bad.select(F.lit("rank_sequence").alias("code"), F.concat_ws(",", "low", "high", "n", "all").alias("example"))


def check_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (code, example) per column that has repeated values."""
    counts = df.agg(F.count("*").alias("all"), *[F.countDistinct(c).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.col(c).alias("n"), F.col("all").alias("all")) for c in columns])).alias("x")).filter("x.n <> x.all").select("x.code", F.concat_ws(",", "x.n", "x.all").alias("example"))


def quality_summary(df: DataFrame, gaps: Column, phrase: Column) -> DataFrame:
    """One row: total, complete, incomplete, words, phrases, percent complete (3 decimals)."""
    s = df.select(gaps.alias("g"), phrase.alias("p")).agg(
        F.count("*").alias("total"), F.count_if(F.size("g") == 0).alias("complete"), F.count_if(F.size("g") > 0).alias("incomplete"), F.count_if(~F.col("p")).alias("words"), F.count_if("p").alias("phrases")
    )
    return s.withColumn("percent", F.when(F.col("total") == 0, 100.0).otherwise(F.round(100.0 * F.col("complete") / F.col("total"), 3)))


def gap_histogram(df: DataFrame, gaps: Column) -> DataFrame:
    """Rows per gap."""
    return df.select(F.explode(gaps).alias("gap")).groupBy("gap").agg(F.count("*").alias("n"))


def attempt_totals(state: DataFrame) -> DataFrame:
    """Rows and attempts per status."""
    return state.groupBy("status").agg(F.count("*").alias("n"), F.sum("attempts").alias("attempts"))


def latest_attempt(state: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The newest row of each key."""
    rest = [c for c in state.columns if c not in keys]
    return state.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("r")).select(*keys, "r.*")


def staleness(state: DataFrame, keys: list[str], at: str, now: Column, limit_seconds: float) -> DataFrame:
    """One row: the newest attempt of all with its age, and whether that is more than max(60 s, the limit).

    Among rows of one time the one with the greatest keys counts; an empty state is stale.
    """
    rest = [c for c in state.columns if c not in (at, *keys)]
    newest = state.agg(F.max_by(F.struct(*keys, *rest, at), F.struct(at, *keys)).alias("r")).select("r.*")
    age = F.when(F.col(at).isNotNull(), F.greatest(F.lit(0.0), now.cast("double") - F.col(at).cast("timestamp").cast("double")))
    return newest.withColumn("stale_seconds", F.round(age, 1)).withColumn("stale", F.coalesce(age > max(60.0, limit_seconds), F.lit(True)))


def change_stats(before: DataFrame, after: DataFrame, key: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """Per column, how many rows changed and how many list values were added."""
    b, a = before.alias("b"), after.alias("a")
    joined = b.join(a, key)
    changed = [F.count_if(~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))).alias(f"{c}_changed") for c in scalars]
    added = [F.coalesce(F.sum(F.size(f"a.{c}") - F.size(f"b.{c}")), F.lit(0)).alias(f"{c}_added") for c in lists]
    return joined.agg(F.count("*").alias("n_rows"), *changed, *added)


def case_collisions(df: DataFrame, key: str, form: str) -> DataFrame:
    """Keys with more written forms than case-folded ones."""
    return df.groupBy(key).agg(F.countDistinct(form).alias("forms"), F.countDistinct(F.lower(form)).alias("folded")).filter("folded < forms")


def merge_needs(requests: DataFrame, key: str, flags: list[str]) -> DataFrame:
    """One request per key: a flag is set if any request sets it."""
    return requests.groupBy(key).agg(*[F.bool_or(f).alias(f) for f in flags])


def rejections(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows per reason."""
    return df.groupBy(reason).agg(F.count("*").alias("n"))


def progress_rollup(shards: DataFrame, n_shards: int, counters: list[str], same: list[str]) -> DataFrame:
    """Sum of the shards' counters, and whether all shards report once under one version."""
    sums = [F.sum(c).alias(c) for c in counters]
    whole = (F.count("*") == n_shards) & (F.countDistinct("shard") == n_shards) & (F.min("shard") == 0) & (F.max("shard") == n_shards - 1)
    one = F.lit(True)
    for c in same:
        one = one & (F.countDistinct(c) == 1)
    return shards.agg(*sums, (whole & one).alias("consistent"))


def check_report(reports: DataFrame, version: int | None = None, digest: str | None = None, shards: int | None = None) -> DataFrame:
    """(code, example) rows for counts that are negative or do not add up; and for reports of another
    gate version, of shards that do not exist or report twice, or of another candidate."""
    total, complete, incomplete = F.col("total"), F.col("complete"), F.col("incomplete")
    negative = (total < 0) | (complete < 0) | (incomplete < 0) | total.isNull() | complete.isNull() | incomplete.isNull()
    code = F.when(negative, "negative_count").when(complete + incomplete != total, "sum_mismatch")
    rules = [code]
    if version is not None:
        rules.append(F.when(~F.col("version").eqNullSafe(F.lit(version)), "version_mismatch"))
    if shards is not None:
        rules.append(F.when(~F.coalesce(F.col("shard").between(0, shards - 1), F.lit(False)), "shard_mismatch"))
    if digest is not None:
        malformed = ~F.coalesce(F.col("digest").rlike("^[0-9a-f]{64}$"), F.lit(False))
        rules.append(F.when(malformed, "digest_malformed").when(F.col("digest") != digest, "digest_mismatch"))
    example = F.col("shard").cast("string").alias("example")
    found = reports.select(F.explode(F.filter(F.array(*rules), lambda c: c.isNotNull())).alias("code"), example)
    if shards is None:
        return found
    twice = reports.groupBy("shard").count().filter("count > 1").select(F.lit("shard_repeated").alias("code"), example)
    return found.unionByName(twice)


def clamped(reports: DataFrame) -> DataFrame:
    """Reports whose ``finished`` lies between 0 and ``total``, with the percentage that follows."""
    finished = F.least(F.greatest(F.col("finished"), F.lit(0)), F.col("total"))
    return reports.withColumn("finished", finished).withColumn("percent", F.when(F.col("total") == 0, 100.0).otherwise(F.round(100.0 * F.col("finished") / F.col("total"), 3)))
