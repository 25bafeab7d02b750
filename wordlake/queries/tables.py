"""Queries over the star-schema tables and events: ranks, joins, checks, streams' batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordlake.functions import collect, normalize
from wordlake.operators import aggregates, joins, lookup, rank
from wordlake.plans import enrich
from wordlake.queries.base import table
from wordlake.streaming import streams


#: Order lines that a task pairs at once.
SHARE = 250_000


def global_rank(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of all order lines, and their rank by price.

    Nulls come last, as in its SQL; lines that its order leaves tied stand by their other columns, so the ranks are the same in every run.
    """
    lines = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber"]
    order += [c for c in lines.columns if c not in order and c != "l_extendedprice"]
    return rank.global_rank(lines, [F.desc("l_extendedprice"), *[F.asc_nulls_last(c) for c in order]])


def zigzag_order(spark: SparkSession, sf: str) -> DataFrame:
    return rank.zigzag(table(spark, sf, "part").select("p_partkey", "p_retailprice"), [F.desc("p_retailprice"), F.asc("p_partkey")]).select("p_partkey", "slot")


def ordered_capped_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer the first 40 different part names in order of their order lines."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)
    return collect.ordered_lists(joined, ["o_custkey"], F.col("p_name"), F.col("l_orderkey"), F.col("l_linenumber"), out="names").withColumn("names", F.array_join("names", "|"))


def append_capped(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer the order priorities of the first half of 1996's orders, then the rest's, at most 3."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    lists = orders.groupBy("o_custkey").agg(
        collect.collect_ordered(F.when(F.expr("o_orderkey % 2 = 0"), F.col("o_orderpriority")), F.col("o_orderkey"), cap=2).alias("old"),
        collect.collect_ordered(F.when(F.expr("o_orderkey % 2 = 1"), F.col("o_orderpriority")), F.col("o_orderkey")).alias("new"),
    )
    return lists.select("o_custkey", F.array_join(collect.append_capped(F.col("old"), F.col("new"), 3), "|").alias("merged"))


def phrase_classify(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    phrase = normalize.is_phrase(F.col("p_name"), F.col("p_type"))
    evidence = normalize.phrase_evidence(F.col("p_name"), F.lit("phrase"), F.array(F.lit("kaikki")), F.lit(None).cast("string"), F.when(F.expr("p_size % 2 = 0"), "1"))
    return parts.select("p_partkey", phrase.alias("phrase"), evidence.alias("evidence"))


def title_variants(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return parts.select("p_partkey", F.explode(lookup.title_variants(normalize.norm_key(F.col("p_name")))).alias("variant"))


def semi_match(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    lines = table(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_orderkey").alias("k"))
    return joins.split_matches(orders, lines, "k")[0]


def anti_match(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    lines = table(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_orderkey").alias("k"))
    return joins.split_matches(orders, lines, "k")[1]


def overlay_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Customers overlaid with suppliers of the same key: blank names filled, segments united."""
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.when(F.expr("c_custkey % 3 = 0"), "").otherwise(F.col("c_name")).alias("name"), F.array("c_mktsegment").alias("tags"))
    patch = table(spark, sf, "supplier").select((F.col("s_suppkey") * 3).alias("key"), F.col("s_name").alias("name"), F.array(F.lit("supplier"), F.lit("BUILDING")).alias("tags"))
    return joins.overlay(base, patch, "key", ["name"], ["tags"]).withColumn("tags", F.array_join("tags", "|"))


def synonym_self_join(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of different parts that share an order, with the number of such orders.

    Orders are dealt once, in shares of about ``SHARE`` lines, so what a task sorts, pairs and counts does not grow with the table.
    """
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("a"))
    a = lines.repartition(1 + lines.count() // SHARE, "k").distinct()
    b = a.select("k", F.col("a").alias("b"))
    return a.join(b, "k").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n_orders"))


def relation_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Region - nation - customer - order - line - part: revenue and parts per region and brand.

    Orders and parts are dealt in shares of about ``SHARE`` lines; lines are summed per region and part before
    parts are joined, so what a task sorts and counts does not grow with the table.
    """
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf, "region").select("r_regionkey", "r_name")
    # rows alike in part and brand count by their number
    parts = table(spark, sf, "part").groupBy("p_partkey", "p_brand").agg(F.count("*").alias("alike"))
    shares = 1 + lines.count() // SHARE
    homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    placed = orders.repartition(shares, "o_custkey").join(joins.unbroadcast(homes.repartition(shares, "c_custkey")), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name")
    sold = lines.repartition(shares, "l_orderkey").join(joins.unbroadcast(placed.repartition(shares, "o_orderkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    per_part = sold.select("l_partkey", "r_name", "cents").repartition(shares, "l_partkey").groupBy("l_partkey", "r_name").agg(F.sum("cents").alias("cents"), F.count("*").alias("n_lines"))
    joined = per_part.join(joins.unbroadcast(parts.repartition(shares, "p_partkey")), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("r_name", "p_brand").agg(F.sum(F.col("cents") * F.col("alike")).alias("cents"), F.count("*").alias("n_parts"), F.sum(F.col("n_lines") * F.col("alike")).alias("n_lines"))


def status_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.status_histogram(table(spark, sf, "events"), "props", "$.k")


def issue_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Odd order lines by kind, with the first 20 of each."""
    lines = table(spark, sf, "lineitem")
    code = F.when(F.col("l_discount") > 0.09, "high_discount").when(F.col("l_quantity") < 2, "low_quantity").when((F.col("l_tax") == 0) & (F.col("l_returnflag") == "R"), "untaxed_return")
    bad = lines.select(code.alias("code"), F.format_string("%012d-%d", "l_orderkey", "l_linenumber").alias("example")).filter("code is not null")
    return aggregates.issue_rollup(bad).withColumn("examples", F.array_join("examples", ","))


def contiguous_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of events of one type in a row, per user in time order."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    runs = rank.run_id(events, ["event_type"], ["user_id"], [F.col("ts"), F.col("event_id")])
    return runs.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_id")).select("user_id", "run", "event_type", "n", "first_id")


def quota_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """At most two events per day, user and type are admitted."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", F.to_date("ts").cast("string").alias("day"))
    used = rank.running_allowance(events, ["day", "user_id", "event_type"], [F.col("ts"), F.col("event_id")], 2)
    return used.select("event_id", "day", "admitted", F.col("used").cast("long").alias("used"))


def latest_attempt(spark: SparkSession, sf: str) -> DataFrame:
    """Per user and type: attempts so far and the newest one."""
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    last = aggregates.latest_attempt(events, ["user_id", "event_type"], "ts", "event_id")
    totals = events.groupBy("user_id", "event_type").agg(F.count("*").alias("attempts"))
    return last.join(totals, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "attempts")


def progress_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of two shards of events summed, with the check that both report once."""
    shards = table(spark, sf, "events").groupBy(F.expr("user_id % 2").alias("shard")).agg(F.count("*").alias("total"), F.count_if(F.col("value") > 0).alias("complete"), F.lit("v1").alias("version"))
    return aggregates.progress_rollup(shards, 2, ["total", "complete"], ["version"])


def daily_window(spark: SparkSession, sf: str) -> DataFrame:
    """Events per day and type: the batch twin of the progress stream."""
    windows = streams.progress_windows(streams.timed(table(spark, sf, "events")), "1 day", status="event_type")
    return windows.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stalls(spark: SparkSession, sf: str) -> DataFrame:
    """Silences of more than 45 minutes between a user's events: count and longest in seconds."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gaps = table(spark, sf, "events").withColumn("gap", F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lag("ts").over(w).cast("timestamp")))
    return gaps.filter("gap > 2700").groupBy("user_id").agg(F.count("*").alias("n_stalls"), F.max("gap").alias("longest"))


def session_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a user's events parted by 45 minutes of silence: the batch twin of the stream."""
    sessions = streams.stalls(streams.timed(table(spark, sf, "events")))
    return sessions.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("largest"))


def retry_worklist(spark: SparkSession, sf: str) -> DataFrame:
    """Users whose newest event is no purchase and older than a day at a fixed moment."""
    state = aggregates.latest_attempt(table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts", "event_id")
    entries = state.select("user_id", F.when(F.col("event_type") == "purchase", "completed").otherwise("partial").alias("status"), F.col("ts").cast("timestamp").alias("last_attempt"))
    return enrich.worklist(entries, F.lit("2024-01-31 00:00:00").cast("timestamp"), 24).select("user_id", "status")


def needs_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Per user the wishes of all events together."""
    events = table(spark, sf, "events").select("user_id", (F.col("value") > 50).alias("dictionary"), (F.col("event_type") == "click").alias("exact"), (F.col("value") < 5).alias("related"))
    return aggregates.merge_needs(events, "user_id", ["dictionary", "exact", "related"])


def provider_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that the merged wishes need, and their cost."""
    events = table(spark, sf, "events")
    needs = aggregates.merge_needs(
        events.select(F.col("user_id").alias("term"), (F.col("value") > 20).alias("definition"), (F.col("event_type") == "click").alias("us_phonetic"), (F.col("value") < 5).alias("relations")), "term", ["definition", "us_phonetic", "relations"]
    )
    found = events.groupBy(F.col("user_id").alias("term")).agg(F.bool_or(F.col("value") > 60).alias("has_definition"), F.bool_or(F.col("event_type") == "view").alias("has_us"))
    return enrich.provider_plan(needs, found)


def case_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Part types and brands whose written forms differ only in case, by size."""
    parts = table(spark, sf, "part")
    forms = parts.select("p_size", F.explode(F.array("p_type", F.lower("p_type"))).alias("form"))
    return aggregates.case_collisions(forms, "p_size", "form")


def eligible_first(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred parts: those under 1,500 by size, dearest first, then others by key."""
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    return rank.eligible_first(parts, F.col("p_retailprice") < 1500, F.col("p_size") * 1_000_000 - F.col("p_partkey"), "p_partkey", 100).select("p_partkey")


def unique_checks(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.check_unique(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line")), ["l_orderkey", "l_partkey", "line"])


QUERIES = {
    f.__name__: f
    for f in (
        global_rank, zigzag_order, ordered_capped_lists, append_capped, phrase_classify, title_variants, semi_match, anti_match, overlay_upsert, synonym_self_join, relation_expand, status_histogram, issue_rollup,
        contiguous_runs, quota_ledger, latest_attempt, progress_rollup, daily_window, stalls, session_gaps, retry_worklist, needs_merge, provider_plan, case_collisions, eligible_first, unique_checks,
    )
}

LINE_NAMES = "SELECT o_custkey, p_name, l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
SQL = {
    "global_rank": "SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem",
    "zigzag_order": """SELECT p_partkey, CASE WHEN p < (n + 1) // 2 THEN 2 * p ELSE 2 * (n - 1 - p) + 1 END AS slot
      FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS p, count(*) OVER () AS n FROM part)""",
    "ordered_capped_lists": f"""
      WITH f AS (SELECT o_custkey, p_name, min((l_orderkey, l_linenumber)) AS o FROM ({LINE_NAMES}) GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o, p_name) AS k FROM f)
      SELECT o_custkey, string_agg(p_name, '|' ORDER BY k) AS names FROM r WHERE k <= 40 GROUP BY o_custkey""",
    "append_capped": """
      WITH f AS (SELECT o_custkey, o_orderpriority AS p, o_orderkey % 2 AS late, min(o_orderkey) AS o FROM orders GROUP BY ALL),
      a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o) AS k FROM f WHERE late = 0 QUALIFY k <= 2),
      b AS (SELECT f.*, row_number() OVER (PARTITION BY f.o_custkey ORDER BY f.o) AS k FROM f ANTI JOIN a ON a.o_custkey = f.o_custkey AND a.p = f.p WHERE f.late = 1),
      u AS (SELECT o_custkey, p, 0 AS late, k FROM a UNION ALL SELECT o_custkey, p, 1, k FROM b),
      r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY late, k) AS n FROM u)
      SELECT o_custkey, coalesce(string_agg(p, '|' ORDER BY n) FILTER (n <= 3), '') AS merged FROM r GROUP BY o_custkey""",
    "phrase_classify": "SELECT p_partkey, contains(trim(p_name), ' ') OR regexp_matches(p_name, '[^-]-[^-]') AS phrase, 'explicit-pos+kaikki-entry' || CASE WHEN p_size % 2 = 0 THEN '+ecdict-oxford' ELSE '' END AS evidence FROM part",
    "title_variants": "SELECT DISTINCT p_partkey, unnest([lower(p_name), CASE WHEN contains(p_name, '-') THEN replace(lower(p_name), '-', ' ') ELSE replace(lower(p_name), ' ', '-') END]) AS variant FROM part",
    "semi_match": "SELECT o_orderkey AS k, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)",
    "anti_match": "SELECT o_orderkey AS k, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)",
    "overlay_upsert": """SELECT coalesce(c_custkey, s_suppkey * 3) AS key, CASE WHEN c_custkey IS NOT NULL AND c_custkey % 3 <> 0 THEN c_name ELSE coalesce(s_name, CASE WHEN c_custkey IS NOT NULL THEN '' END) END AS name,
      CASE WHEN s_suppkey IS NULL THEN c_mktsegment WHEN c_custkey IS NULL THEN 'supplier|BUILDING' WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING|supplier' ELSE c_mktsegment || '|supplier|BUILDING' END AS tags
      FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 3""",
    "synonym_self_join": "WITH l AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS p FROM lineitem) SELECT x.p AS a, y.p AS b, count(*) AS n_orders FROM l x JOIN l y ON x.k = y.k AND x.p < y.p GROUP BY ALL",
    "relation_expand": """SELECT r_name, p_brand, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(DISTINCT l_partkey) AS n_parts, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "status_histogram": "SELECT coalesce(json_extract_string(props, '$.k'), 'pending') AS status, count(*) AS n FROM events GROUP BY ALL",
    "issue_rollup": """
      WITH v AS (SELECT CASE WHEN l_discount > 0.09 THEN 'high_discount' WHEN l_quantity < 2 THEN 'low_quantity' WHEN l_tax = 0 AND l_returnflag = 'R' THEN 'untaxed_return' END AS code, printf('%012d-%d', l_orderkey, l_linenumber) AS example FROM lineitem),
      r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY example) AS k FROM v WHERE code IS NOT NULL)
      SELECT code, count(*) AS n, string_agg(example, ',' ORDER BY example) FILTER (k <= 20) AS examples FROM r GROUP BY code""",
    "contiguous_runs": """
      WITH n AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND lag(event_id) OVER w IS NOT NULL THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM n)
      SELECT user_id, run, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first_id FROM r GROUP BY user_id, run""",
    "quota_ledger": """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, k <= 2 AS admitted, least(k, 2) AS used
      FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY ts, event_id) AS k FROM events)""",
    "latest_attempt": "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, count(*) AS attempts FROM events GROUP BY user_id, event_type",
    "progress_rollup": "SELECT count(*) AS total, count(*) FILTER (value > 0) AS complete, count(DISTINCT user_id % 2) = 2 AS consistent FROM events",
    "daily_window": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stalls": """SELECT user_id, count(*) AS n_stalls, max(gap) AS longest FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS gap FROM events)
      WHERE gap > 2700 GROUP BY user_id""",
    "session_gaps": """
      WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 45 MINUTE THEN 0 ELSE 1 END AS new FROM events),
      s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS s FROM g), n AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY ALL)
      SELECT user_id, count(*) AS sessions, max(n) AS largest FROM n GROUP BY user_id""",
    "retry_worklist": """WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS t, max(ts) AS ts FROM events GROUP BY user_id)
      SELECT user_id, 'partial' AS status FROM l WHERE t IS DISTINCT FROM 'purchase' AND ts <= TIMESTAMP '2024-01-30 00:00:00'""",
    "needs_merge": "SELECT user_id, bool_or(value > 50) AS dictionary, bool_or(event_type = 'click') AS exact, bool_or(value < 5) AS related FROM events GROUP BY user_id",
    "provider_plan": """
      WITH e AS (SELECT user_id AS term, bool_or(value > 20) AS d, bool_or(event_type = 'click') AS u, bool_or(value < 5) AS r, bool_or(value > 60) AS hd, bool_or(event_type = 'view') AS hu FROM events GROUP BY user_id),
      p AS (SELECT term, d OR u AS dictionary, (d AND NOT hd) OR (u AND NOT hu) AS exact, r AS related FROM e)
      SELECT term, dictionary, exact, related, CAST(dictionary AS BIGINT) + CAST(exact AS BIGINT) + 3 * CAST(related AS BIGINT) AS cost FROM p""",
    "case_collisions": "SELECT p_size, count(DISTINCT f) AS forms, count(DISTINCT lower(f)) AS folded FROM (SELECT p_size, unnest([p_type, lower(p_type)]) AS f FROM part) GROUP BY p_size HAVING count(DISTINCT lower(f)) < count(DISTINCT f)",
    "eligible_first": "SELECT p_partkey FROM part ORDER BY p_retailprice >= 1500, CASE WHEN p_retailprice < 1500 THEN p_partkey - p_size * 1000000 END, p_partkey LIMIT 100",
    "unique_checks": """WITH c AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS a, count(DISTINCT l_partkey) AS b, count(DISTINCT l_orderkey || '-' || l_linenumber) AS c FROM lineitem)
      SELECT code, v || ',' || n AS example FROM (SELECT n, unnest(['l_orderkey', 'l_partkey', 'line']) AS code, unnest([a, b, c]) AS v FROM c) WHERE v <> n""",
}
