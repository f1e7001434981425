"""Streaming forms of the event operators."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators import events


def upload_stream(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON notifications from a folder, with their arrival time."""
    return spark.readStream.text(path).withColumn("ts", F.current_timestamp())


def requests(stream: DataFrame, patterns: list[tuple[str, str]], seconds: int = 300, late: str = "10 minutes") -> DataFrame:
    """One row for each brand and tumbling window: bucket and key of the earliest upload, coalesced_count, window.

    ``stream`` has value and ts (a timestamp, not one without zone). Uploads later than ``late`` are dropped."""
    rows = events.with_brand(events.uploads(stream.withWatermark("ts", late)), patterns)
    n = F.count(F.lit(1))
    out = rows.groupBy(F.window("ts", f"{seconds} seconds"), "brand").agg(F.min_by(F.struct("bucket", "key"), F.struct("ts", "key")).alias("f"), F.when(n > 1, n).alias("coalesced_count"))
    return out.select("window", "brand", "f.bucket", "f.key", "coalesced_count")


def once_a_window(stream: DataFrame, seconds: int = 300, late: str = "10 minutes") -> DataFrame:
    """The first start of each brand and window; later ones are duplicates while the watermark keeps them."""
    numbered = stream.withColumn("window_number", events.window_number(F.col("ts"), seconds))
    return numbered.withWatermark("ts", late).dropDuplicatesWithinWatermark(["brand", "window_number"])


class InFlight(StatefulProcessor):
    """What runs for a brand: its status, and until when (in milliseconds of event time) it counts without further word. A brand without a running
    execution has no state: an execution that ends frees it at once, a silent one when the watermark has passed its time."""

    def __init__(self, silence_ms: int):
        self.silence = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("running", "status string, until long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat([f[["ts", "kind", "status"]] for f in rows])
        own = own.assign(ms=own["ts"].astype("datetime64[ms]").astype("int64"), later=own["kind"] != "status").sort_values(["ms", "later"], kind="stable")
        before = self.state.get() if self.state.exists() else None
        until = before[1] if before else None  # nothing runs without it
        status = before[0] if before else ""
        skipped = []
        for kind, new, ms in zip(own["kind"], own["status"], own["ms"].tolist()):
            if kind == "status":
                status = new if isinstance(new, str) else UNKNOWN
                until = ms + self.silence if status in events.TERMINAL_FREE or status == UNKNOWN else None
            else:
                skipped.append(until is not None and ms <= until)
                if not skipped[-1]:
                    status, until = "Executing", ms + self.silence
        if before:
            self.handle.deleteTimer(before[1])
        if until is None:
            self.state.clear()
        else:
            self.state.update((status, until))
            self.handle.registerTimer(until)
        if skipped:
            yield pd.DataFrame({"brand": key[0], "kind": "request", "skipped": skipped})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists() and self.state.get()[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


#: Status where the listing of executions failed: it counts as running.
UNKNOWN = "Unknown"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """What ``suppress_running`` needs: state beyond the executors' memory, and timers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def suppress_running(stream: DataFrame, silence: timedelta = timedelta(hours=6), late: str = "10 minutes") -> DataFrame:
    """(brand, kind, skipped) for rows of (brand, kind, status, ts): 'status' rows set a brand's state, 'request' rows are skipped while it
    is running, and otherwise start one. A micro-batch's rows of a brand are taken in the order of ts, a status before a request of the same
    time; rows later than ``late`` are dropped.

    A null status (the listing failed) counts as running. An execution that nothing is heard of for ``silence`` no longer counts, so one
    lost word doesn't stop a brand for good. State is one row a running brand; it needs ``keep_state_in_rocksdb``."""
    if stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError("call keep_state_in_rocksdb(spark) first")
    rows = stream.withWatermark("ts", late)
    return rows.groupBy("brand").transformWithStateInPandas(InFlight(int(silence.total_seconds() * 1000)), "brand string, kind string, skipped boolean", "append", "eventTime")


def alarms(signals: DataFrame, seconds: int = 300, late: str = "10 minutes") -> DataFrame:
    top = signals.withWatermark("ts", late).groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "endpoint").agg(F.max("level").alias("level"))
    return top.select("endpoint", F.col("w.start").alias("window_start"), "level", *((F.col("level") >= n).alias(f"level{n}") for n in (1, 2, 3)))


def sessions(rows: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return rows.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "brand").agg(F.count(F.lit(1)).alias("n"))


def publish(stream: DataFrame, checkpoint: str, send: Callable[[list[dict]], int], every: str | None = None) -> StreamingQuery:
    """Each micro-batch's requests in batches of at most ten."""

    def batch(df: DataFrame, _: int) -> None:
        events.publish(df, "brand", send)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def wait(query: StreamingQuery, timeout: float = 21_600.0, poll: float = 30.0, clock: Callable[[], float] = time.monotonic) -> None:
    """Until the query ends; an error in it is raised, a timeout as well. ``clock`` tells the seconds."""
    end = clock() + timeout
    while not query.awaitTermination(max(0.001, min(poll, end - clock()))):
        if clock() >= end:
            query.stop()
            raise TimeoutError(f"not ended after {timeout:g} s")
