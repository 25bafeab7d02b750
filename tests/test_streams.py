import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF
from wordlake.streaming import streams


def run(query_df, mode, spark, name):
    q = query_df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.processAllAvailable()
    q.awaitTermination(60)
    return spark.table(name)


def events(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).repartition(1).sortWithinPartitions("ts").write.mode("overwrite").parquet(str(tmp_path / "e"))
    return spark.readStream.schema(spark.read.parquet(str(tmp_path / "e")).schema).parquet(str(tmp_path / "e"))


def test_windows_equal_the_batch(spark, tmp_path):
    got = run(streams.progress_windows(streams.timed(events(spark, tmp_path)), "1 day", status="event_type"), "append", spark, "w1")
    batch = spark.read.parquet(str(tmp_path / "e")).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
    last = batch.agg(F.max("start")).first()[0]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.filter(F.col("start") < last).collect()))


def test_attempts(spark, tmp_path):
    got = run(streams.attempt_state(streams.timed(events(spark, tmp_path)), ["user_id"], status="event_type"), "complete", spark, "w2")
    assert got.agg(F.sum("attempts")).first()[0] == 1000


def test_stalls(spark, tmp_path):
    got = run(streams.stalls(streams.timed(events(spark, tmp_path))), "append", spark, "w3")
    batch = spark.read.parquet(str(tmp_path / "e")).groupBy(F.session_window("ts", "45 minutes"), "user_id").count().count()
    assert 0.9 * batch <= got.count() <= batch


def test_quota(spark, tmp_path):
    rows = pd.DataFrame({"day": ["2024-01-01"] * 5, "client": ["c"] * 5, "kind": ["export"] * 5, "id": range(5), "amount": [2, 2, 2, 1, 1], "ts": pd.to_datetime(["2024-01-01"] * 5)})
    spark.createDataFrame(rows).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "q"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "q")).schema).parquet(str(tmp_path / "q"))
    got = run(streams.quota_ledger(streams.timed(source), {"export": 5}), "append", spark, "w4")
    assert [r["admitted"] for r in got.orderBy("id").collect()] == [True, True, False, True, False]


def test_quota_calls_python_once_per_share(spark, tmp_path):
    """Python's work goes by shares of a day; keys of one share, nulls among them, and limits by kind stay apart."""
    n = 600
    rows = spark.range(n).select(F.lit("2024-01-01").alias("day"), F.when(F.col("id") % 300 != 7, F.col("id") % 300).alias("client"), F.when(F.col("id") % 2 == 0, "export").otherwise("other").alias("kind"), "id", F.lit(2).alias("amount"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("ts"))
    rows.coalesce(1).write.parquet(str(tmp_path / "k"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "k")).schema).parquet(str(tmp_path / "k"))
    ledger = streams.quota_ledger(streams.timed(source), {"export": 3}, other=5, shares=2)
    assert "__share" in ledger._jdf.queryExecution().analyzed().toString()
    got = {r.id: r for r in run(ledger, "append", spark, "w6").collect()}
    assert len(got) == n and all(r.admitted == (i < 300 or i % 2 == 1) for i, r in got.items())
    assert all((r.client, r.kind) == (None if i % 300 == 7 else i % 300, "export" if i % 2 == 0 else "other") for i, r in got.items())
    assert all(r.remaining == (1 if i % 2 == 0 else 3 if i < 300 else 1) for i, r in got.items())


def test_a_silent_key_is_reported_by_its_timer(spark, tmp_path):
    """No further event of the key comes: the watermark of the others fires its timer."""
    at = lambda *minutes: [pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=m) for m in minutes]
    rows = [(1, t) for t in at(0, 10, 20)] + [(2, t) for t in at(*range(0, 400, 20))] + [(3, t) for t in at(0, 90)]
    spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "ts"])).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "s"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "s")).schema).parquet(str(tmp_path / "s"))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        got = run(streams.silence_alerts(streams.timed(source)), "append", spark, "w5")
        minute = (F.col("last_seen").cast("long") - F.lit(pd.Timestamp("2024-01-01").timestamp()).cast("long")) / 60
        assert sorted(tuple(r) for r in got.select("user_id", minute.cast("int"), "by_timer").collect()) == [(1, 20, True), (3, 0, False), (3, 90, True)]
    finally:
        spark.conf.set(key, before)
