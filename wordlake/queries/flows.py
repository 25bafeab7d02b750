"""Queries that run the streaming jobs over the events table, from a stream source to a sink and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.operators.lineage import fresh_path
from wordlake.queries.base import table
from wordlake.streaming import streams


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events, landed as files in a folder, as a stream with its watermark."""
    path = fresh_path(spark, "landing")
    table(spark, sf, "events").write.parquet(path)
    return streams.timed(spark.readStream.schema(table(spark, sf, "events").schema).parquet(path))


def landed(stream: DataFrame, name: str) -> DataFrame:
    """All that the stream appends until its source is used up."""
    spark, path = stream.sparkSession, fresh_path(stream.sparkSession, name)
    query = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def stream_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Newest status and attempts per user: the updates of each batch are appended, the last one of a user counts."""
    path = fresh_path(spark, "attempts")
    state = streams.attempt_state(event_stream(spark, sf), ["user_id"], status="event_type")
    write = lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{path}/rows")
    state.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/state").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows").groupBy("user_id").agg(F.max_by("status", "batch").alias("status"), F.max_by("attempts", "batch").alias("attempts"))


def stream_quota(spark: SparkSession, sf: str) -> DataFrame:
    """Two events per day, user and type are admitted."""
    requests = event_stream(spark, sf).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("user_id").alias("client"), F.col("event_type").alias("kind"), F.col("event_id").alias("id"), F.lit(1).alias("amount"), "ts")
    return landed(streams.quota_ledger(requests, {}, other=2), "quota").select("id", "admitted", "remaining")


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Events per hour and type, of the hours that the watermark has passed."""
    return landed(streams.progress_windows(event_stream(spark, sf), "1 hour", status="event_type"), "progress").select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


def stream_stalls(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions parted by 45 minutes of silence that the watermark has passed: per user how many, and the largest."""
    sessions = landed(streams.stalls(event_stream(spark, sf)), "stalls")
    return sessions.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("largest"))


ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_silence(spark: SparkSession, sf: str) -> DataFrame:
    """Every silence of 45 minutes, and how it was noticed: by the user's next event, or by the user's timer."""
    before = spark.conf.get(ROCKSDB[0])
    spark.conf.set(*ROCKSDB)
    try:
        alerts = landed(streams.silence_alerts(event_stream(spark, sf)), "silence")
    finally:
        spark.conf.set(ROCKSDB[0], before)
    return alerts.select("user_id", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "by_timer")


def stream_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Events received late, early or in time: those that are fresh."""
    received = event_stream(spark, sf).withColumn("received_at", F.col("ts") + F.expr("make_interval(0, 0, 0, 0, CAST(event_id % 6 AS INT) - 1)"))
    return landed(streams.fresh_only(received), "fresh").select("event_id")


QUERIES = {f.__name__: f for f in (stream_attempts, stream_quota, stream_progress, stream_stalls, stream_silence, stream_freshness)}

SQL = {
    "stream_attempts": "SELECT user_id, arg_max(event_type, ts) AS status, count(*) AS attempts FROM events GROUP BY user_id",
    "stream_quota": """SELECT event_id AS id, k <= 2 AS admitted, greatest(2 - k, 0) AS remaining
      FROM (SELECT event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY ts, event_id) AS k FROM events)""",
    "stream_progress": """SELECT strftime(h, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM (SELECT date_trunc('hour', ts) AS h, event_type FROM events)
      WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""",
    "stream_stalls": """
      WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 45 MINUTE THEN 0 ELSE 1 END AS new FROM events),
      s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS s FROM g), n AS (SELECT user_id, s, count(*) AS n, max(ts) + INTERVAL 45 MINUTE AS stop FROM s GROUP BY ALL)
      SELECT user_id, count(*) AS sessions, max(n) AS largest FROM n WHERE stop <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY user_id""",
    "stream_silence": """
      WITH t AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events)
      SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_seen, next IS NULL AS by_timer FROM t
      WHERE next - ts >= INTERVAL 45 MINUTE OR next IS NULL AND ts + INTERVAL 45 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "stream_freshness": "SELECT event_id FROM events WHERE event_id % 6 BETWEEN 1 AND 4",
}
