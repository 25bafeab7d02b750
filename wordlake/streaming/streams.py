"""Streams of events: attempt state, quotas, progress windows, stalls, freshness.

Event time must be a timestamp with time zone; NTZ columns are cast first.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def timed(stream: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The stream with its watermark."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def attempt_state(stream: DataFrame, keys: list[str], ts: str = "ts", status: str = "status") -> DataFrame:
    """Per key the newest status and the attempts so far (update mode)."""
    return stream.groupBy(*keys).agg(F.max_by(status, ts).alias("status"), F.max(ts).alias("updated_at"), F.count("*").alias("attempts"))


def quota_ledger(stream: DataFrame, limits: dict[str, int], keys: tuple[str, ...] = ("day", "client", "kind"), other: int = 0, shares: int = 256) -> DataFrame:
    """Requests (keys, id, amount) with ``admitted`` and ``remaining``; refusals use nothing.

    ``limits`` go by the last key; kinds that it does not name have the limit ``other``.  A day's keys
    are dealt to ``shares``, so that Python is called once per share and not once per key. State is one number per key that has
    used something, one text per share; it goes when the watermark has passed the share's day.
    """
    names = list(keys)
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    named = F.struct(*names)
    dealt = stream.select(F.col(names[0]).alias("__day"), F.pmod(F.xxhash64(*names), F.lit(shares)).alias("__share"), F.to_json(named).alias("__key"), F.col(names[-1]).alias("__kind"), "id", "amount", "ts")

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        used = json.loads(state.get[0]) if state.exists else {}
        rows = pd.concat(list(frames)).sort_values(["ts", "id"])
        out = []
        for name, kind, i, amount in zip(rows["__key"], rows["__kind"], rows["id"], rows["amount"], strict=True):
            so_far, limit = used.get(name, 0), limits.get(kind, other)
            fine = so_far + amount <= limit
            if fine:
                so_far = used[name] = so_far + int(amount)
            out.append((name, i, fine, limit - so_far))
        state.update((json.dumps(used),))
        day_end = int((pd.Timestamp(key[0]) + pd.Timedelta(days=1)).timestamp() * 1000)
        state.setTimeoutTimestamp(max(day_end, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["__key", "id", "admitted", "remaining"])

    out = dealt.groupBy("__day", "__share").applyInPandasWithState(step, "__key string, id long, admitted boolean, remaining long", "used string", "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("__key", F.from_json("__key", ", ".join(f"{k} {types[k]}" for k in names))).select("__key.*", "id", "admitted", "remaining")


def progress_windows(stream: DataFrame, width: str = "5 minutes", ts: str = "ts", status: str = "status") -> DataFrame:
    """Rows per window and status (append mode)."""
    return stream.groupBy(F.window(ts, width).alias("w"), status).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), status, "n")


def stalls(stream: DataFrame, silence: str = "45 minutes", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Sessions of activity per key; the end of each is the beginning of a stall (append mode)."""
    sessions = stream.groupBy(F.session_window(ts, silence).alias("w"), key).agg(F.count("*").alias("n"), F.max(ts).alias("last_seen"))
    return sessions.select(key, F.col("w.start").alias("start"), "last_seen", "n")


class SilenceWatch(StatefulProcessor):
    """Per key the time it was last seen, and a timer that speaks up once it has been silent too long."""

    def __init__(self, key: str, ts: str, silence_ms: int) -> None:
        self.key, self.ts, self.silence_ms = key, ts, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "ms long")

    def alert(self, key: tuple, ms: int, by_timer: bool) -> tuple:
        return (key[0], pd.Timestamp(ms, unit="ms", tz="UTC").tz_localize(None), by_timer)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        times = sorted(int(t.timestamp() * 1000) for frame in rows for t in frame[self.ts])
        out, last = [], self.seen.get()[0] if self.seen.exists() else None
        for ms in times:
            if last is not None and ms - last >= self.silence_ms:
                out.append(self.alert(key, last, False))
            last = ms if last is None else max(last, ms)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.seen.update((last,))
        self.handle.registerTimer(last + self.silence_ms)
        yield pd.DataFrame(out, columns=[self.key, "last_seen", "by_timer"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = self.seen.get()[0]
        self.seen.clear()
        yield pd.DataFrame([self.alert(key, last, True)], columns=[self.key, "last_seen", "by_timer"])

    def close(self) -> None:
        pass


def silence_alerts(stream: DataFrame, silence: str = "45 minutes", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """key, last_seen, by_timer: each silence of a key, reported when it is over or, by the key's own
    timer, once the watermark has passed its length: no further event of the key is needed (append mode).

    Needs the RocksDB state store.
    """
    kind = stream.schema[key].dataType.simpleString()
    watch = SilenceWatch(key, ts, int(pd.Timedelta(silence).total_seconds() * 1000))
    return stream.select(key, ts).groupBy(key).transformWithStateInPandas(watch, f"{key} {kind}, last_seen timestamp, by_timer boolean", "Append", "EventTime")


def fresh_only(stream: DataFrame, max_age: str = "3 hours", ts: str = "ts", now: str = "received_at") -> DataFrame:
    """Rows that were neither too old nor from the future when received."""
    return stream.filter((F.col(ts) <= F.col(now)) & (F.col(ts) >= F.col(now) - F.expr(f"interval {max_age}")))
