"""Ranks, interleaving, runs and bounded selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlake.operators.lineage import cut_lineage

#: Shares that meet in one round of a tournament.
FAN = 16


def global_rank(df: DataFrame, order: list[Column], out: str = "rank", parts: int | None = None) -> DataFrame:
    """Dense 1..n over the whole table without a one-task sort.

    Rows are dealt by range and numbered inside their partition; the numbered table is stored once
    in the shared folder, so that the partitions' sizes (one small row each) and the rows stem from
    the same dealing.  ``order`` must be a total order for a fixed result.
    """
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    local = dealt.withColumn("__part", F.spark_partition_id()).withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    local = cut_lineage(local)
    sizes = local.groupBy("__part").agg(F.max("__local").alias("count"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__part", "__before")
    return local.join(F.broadcast(before), "__part").withColumn(out, F.col("__local") + F.col("__before")).drop("__part", "__local", "__before")


def stream_rank(df: DataFrame, kind: str, order: list[Column], limit: int, out: str = "stream_rank", shares: int | None = None) -> DataFrame:
    """Rank within each kind, cut to the first ``limit`` of each.

    A tournament: rows are cut to ``limit`` within hash shares of each kind, then ``FAN`` shares meet
    at a time, so no task ever sorts more than its share or ``FAN`` times ``limit`` rows.
    """
    shares = shares or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = df.withColumn("__share", F.pmod(F.xxhash64(*[f.name for f in df.schema.fields if f.name != kind and "map<" not in f.dataType.simpleString()]), F.lit(shares)))
    while shares > 1:
        left = left.withColumn("__n", F.row_number().over(Window.partitionBy(kind, "__share").orderBy(*order))).filter(F.col("__n") <= limit).drop("__n")
        left = left.withColumn("__share", F.floor(F.col("__share") / FAN))
        shares = -(-shares // FAN)
    return left.drop("__share").withColumn(out, F.row_number().over(Window.partitionBy(kind).orderBy(*order))).filter(F.col(out) <= limit)


def interleave(ranked: DataFrame, is_phrase: Column, limit: int | Column, phrases: int | Column, rank: str = "stream_rank", out: str = "selected_rank") -> DataFrame:
    """Merge two ranked streams so that phrases stand evenly among ``limit`` places.

    The k-th phrase takes place ceil(k * limit / phrases), the j-th word floor((j - 1) * limit /
    (limit - phrases)) + 1.
    """
    limit, phrases = (F.lit(x) if isinstance(x, int) else x for x in (limit, phrases))
    words = limit - phrases
    k = F.col(rank).cast("long")
    phrase_at = F.ceil(k * limit / F.greatest(phrases, F.lit(1))).cast("long")
    word_at = (F.floor((k - 1) * limit / F.greatest(words, F.lit(1))) + 1).cast("long")
    kept = ranked.filter((is_phrase & (k <= phrases)) | (~is_phrase & (k <= words)))
    return kept.withColumn(out, F.when(is_phrase, phrase_at).otherwise(word_at))


def choose_counts(limit: int, phrase_target: int, words: int, phrases: int, least_words: int = 0) -> tuple[int, int]:
    """How many words and phrases to take: the phrase target, words fill up, then either tops up."""
    taken_phrases = min(phrase_target, phrases, limit)
    taken_words = min(words, limit - taken_phrases)
    taken_phrases += min(phrases - taken_phrases, limit - taken_words - taken_phrases)
    taken_words += min(words - taken_words, limit - taken_words - taken_phrases)
    if taken_words + taken_phrases < limit:
        raise ValueError(f"only {taken_words + taken_phrases} rows for an edition of {limit}")
    if taken_words < least_words:
        raise ValueError(f"an edition needs at least {least_words} words")
    return taken_words, taken_phrases


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def order_breaks(df: DataFrame, kind: str, position: str, rank: str) -> DataFrame:
    """Rows whose rank falls below that of the row before them in their kind."""
    w = Window.partitionBy(kind).orderBy(position)
    return df.withColumn("__last", F.lag(rank).over(w)).filter(F.col(rank) < F.col("__last")).drop("__last")


def run_id(df: DataFrame, keys: list[str], scope: list[str], order: list[Column], out: str = "run") -> DataFrame:
    """Number of the contiguous run of equal keys that each row lies in, within its scope."""
    w = Window.partitionBy(*scope).orderBy(*order)
    here, last = F.struct(*keys), F.lag(F.struct(*keys)).over(w)
    return df.withColumn("__new", F.when(here.eqNullSafe(last), 0).otherwise(1)).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def running_allowance(df: DataFrame, keys: list[str], order: list[Column], limit: int) -> DataFrame:
    """Requests of amount 1: used so far and whether each is admitted; refusals use nothing."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).withColumn("admitted", F.col("__n") <= limit).withColumn("used", F.least("__n", F.lit(limit))).drop("__n")


def zigzag(df: DataFrame, order: list[Column], out: str = "slot") -> DataFrame:
    """Largest, smallest, second largest, second smallest, ... as places 0..n-1."""
    n = df.count()
    half, p = (n + 1) // 2, F.col("__p") - 1
    return global_rank(df, order, "__p").withColumn(out, F.when(p < half, 2 * p).otherwise(2 * (n - 1 - p) + 1).cast("long")).drop("__p")


def top_n(df: DataFrame, rank: str, n: int, *ties: str) -> DataFrame:
    """The n best ranked rows; rows without a rank never count."""
    return df.filter(F.col(rank).isNotNull()).orderBy(rank, *ties).limit(n)


def eligible_first(df: DataFrame, eligible: Column, score: Column, key: str, n: int) -> DataFrame:
    """Eligible rows by score, then the others by key, until n are taken."""
    return df.orderBy(F.when(eligible, 0).otherwise(1), F.when(eligible, -score), F.col(key)).limit(n)
