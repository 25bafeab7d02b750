"""Queries over shards, snapshots and digests of the orders and part tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.functions import digest, normalize
from wordlake.operators import aggregates, sets
from wordlake.queries.base import table

COLUMNS = ["o_orderstatus", "o_orderpriority"]


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", *COLUMNS)


def row_digest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", digest.row_digest(F.col("p_partkey"), F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size")).alias("digest"))


def ordered_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Per brand the digest of its parts in key order."""
    parts = table(spark, sf, "part").withColumn("d", digest.row_digest(F.col("p_partkey"), F.col("p_name")))
    return parts.groupBy("p_brand").agg(digest.stream_digest(F.col("p_partkey"), F.col("d")).alias("digest"))


def bucket_digest(spark: SparkSession, sf: str) -> DataFrame:
    return digest.bucket_digest(orders(spark, sf), "o_orderkey", digest.row_digest(F.col("o_orderkey"), F.col("o_orderstatus")))


def replica_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Three replicas of orders, the third with one status changed in every hundred."""
    o = orders(spark, sf)
    out = None
    for i in range(3):
        copy = o.withColumn("o_orderstatus", F.when((F.lit(i) == 2) & (F.col("o_orderkey") % 100 == 0), "X").otherwise(F.col("o_orderstatus")))
        one = digest.table_digest(copy, "o_orderkey", digest.row_digest(F.col("o_orderkey"), F.col("o_orderstatus"))).withColumn("replica", F.lit(i))
        out = one if out is None else out.unionByName(one)
    return sets.compare_replicas(out)


def contiguous_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and id range of each of eight contiguous shards."""
    o = orders(spark, sf)
    bounds = o.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    shard = normalize.shard_of(F.col("o_orderkey"), F.col("low"), F.col("high"), 8)
    return o.join(F.broadcast(bounds)).groupBy(shard.alias("shard")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"))


def owner_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of owner 3 of 8."""
    return normalize.shard_filter(orders(spark, sf), "o_orderkey", 3, 8, "owner").select("o_orderkey", "o_orderstatus")


def snapshots(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [orders(spark, sf).withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit(str(i)))) for i in range(2)]


def owner_merge(spark: SparkSession, sf: str) -> DataFrame:
    return sets.verified_owner_merge(snapshots(spark, sf), "o_orderkey", ["o_custkey"], ["o_orderkey", *COLUMNS]).select("o_orderkey", "o_orderstatus")


def shard_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two disjoint shards, one with nulls, written over the orders."""
    o = orders(spark, sf)
    a = o.filter("o_orderkey % 5 = 1").withColumn("o_orderstatus", F.lit("A"))
    b = o.filter("o_orderkey % 5 = 2").withColumn("o_orderpriority", F.lit(None).cast("string"))
    return sets.merge_shards(o, [a, b], "o_orderkey", COLUMNS)


def exact_union(spark: SparkSession, sf: str) -> DataFrame:
    """Deltas with one id missing in 50, one twice in 70, and one of a wrong owner in 90."""
    expected = orders(spark, sf).select("o_orderkey")
    home = F.pmod(F.col("o_orderkey"), F.lit(4))
    deltas = expected.filter("o_orderkey % 50 <> 0").withColumn("owner", F.when(F.expr("o_orderkey % 90 = 1"), (home + 1) % 4).otherwise(home))
    twice = deltas.filter("o_orderkey % 70 = 3")
    return sets.check_exact_union(expected, deltas.unionByName(twice), "o_orderkey", "owner", 4)


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """A delta that changes status (and sometimes priority) against a central copy with edits of its own."""
    base = orders(spark, sf)
    changed = F.when(F.expr("o_orderkey % 6 = 0"), F.array(F.lit("o_orderstatus"), F.lit("o_orderpriority"))).otherwise(F.array(F.lit("o_orderstatus")))
    delta = base.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("D")).withColumn("o_orderpriority", F.lit("9-DELTA")).withColumn("changed_columns", changed)
    central = base.withColumn("o_orderstatus", F.when(F.expr("o_orderkey % 10 = 0"), "C").otherwise(F.col("o_orderstatus"))).withColumn("o_orderpriority", F.when(F.expr("o_orderkey % 4 = 0"), "8-CENTRAL").otherwise(F.col("o_orderpriority")))
    return sets.three_way(base, delta, central, "o_orderkey", COLUMNS)


def three_way_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merged(spark, sf).select("o_orderkey", *COLUMNS)


def merge_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return merged(spark, sf).select(F.explode("conflicts").alias("column_name")).groupBy("column_name").agg(F.count("*").alias("n"))


def change_stats(spark: SparkSession, sf: str) -> DataFrame:
    """What the shard merge changed."""
    return aggregates.change_stats(orders(spark, sf), shard_merge(spark, sf), "o_orderkey", COLUMNS, [])


QUERIES = {
    f.__name__: f
    for f in (row_digest, ordered_digest, bucket_digest, replica_compare, contiguous_shards, owner_shards, owner_merge, shard_merge, exact_union, three_way_merge, merge_conflicts, change_stats)
}


def framed(column: str) -> str:
    text = f"coalesce(CAST({column} AS VARCHAR), '\\N')"
    return f"length({text}) || ':' || {text}"


ORDER_DIGEST = f"sha256({framed('o_orderkey')} || {framed('o_orderstatus')})"
SHARD_SQL = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 1 THEN 'A' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 2 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""
SQL = {
    "row_digest": f"SELECT p_partkey, sha256({' || '.join(framed(c) for c in ('p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size'))}) AS digest FROM part",
    "ordered_digest": f"SELECT p_brand, sha256(string_agg(sha256({framed('p_partkey')} || {framed('p_name')}), chr(10) ORDER BY p_partkey) || chr(10)) AS digest FROM part GROUP BY p_brand",
    "bucket_digest": f"SELECT o_orderkey // 1000 AS bucket, count(*) AS n_rows, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id, sha256(string_agg({ORDER_DIGEST}, chr(10) ORDER BY o_orderkey) || chr(10)) AS digest FROM orders GROUP BY 1",
    "replica_compare": """WITH c AS (SELECT r, sha256(string_agg(o_orderkey || ':' || CASE WHEN r = 2 AND o_orderkey % 100 = 0 THEN 'X' ELSE o_orderstatus END, ',' ORDER BY o_orderkey)) AS d, count(*) AS n FROM orders, range(3) t(r) GROUP BY r)
      SELECT r AS replica, (d, n) = (SELECT (d, n) FROM c WHERE r = 0) AS same FROM c""",
    "contiguous_shards": """WITH b AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders)
      SELECT ((o_orderkey - low + 1) * 8 - 1) // (high - low + 1) AS shard, count(*) AS n, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders, b GROUP BY 1""",
    "owner_shards": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 8 = 3",
    "owner_merge": "SELECT o_orderkey, o_orderstatus || CAST(o_orderkey % 2 AS VARCHAR) AS o_orderstatus FROM orders",
    "shard_merge": SHARD_SQL,
    "exact_union": """SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'missing' WHEN o_orderkey % 70 = 3 THEN 'overlap' ELSE 'wrong_owner' END AS code, CAST(o_orderkey AS VARCHAR) AS example FROM orders
      WHERE o_orderkey % 50 = 0 OR o_orderkey % 70 = 3 OR o_orderkey % 90 = 1""",
    "three_way_merge": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'D' WHEN o_orderkey % 10 = 0 THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_orderkey % 6 = 0 THEN '9-DELTA' WHEN o_orderkey % 4 = 0 THEN '8-CENTRAL' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "merge_conflicts": """SELECT column_name, count(*) AS n FROM (SELECT 'o_orderstatus' AS column_name FROM orders WHERE o_orderkey % 30 = 0 AND o_orderstatus <> 'C' UNION ALL SELECT 'o_orderpriority' FROM orders WHERE o_orderkey % 12 = 0) GROUP BY 1""",
    "change_stats": "SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 5 = 1 AND o_orderstatus <> 'A') AS o_orderstatus_changed, count(*) FILTER (o_orderkey % 5 = 2 AND o_orderpriority IS NOT NULL) AS o_orderpriority_changed FROM orders",
}
