"""Streams that are stopped, replayed and started again."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta

import pytest

from sievework.streaming import monitor, uploads

KIND = "brand string, kind string, status string, ts timestamp"


class Feed:
    """A folder that a stream reads, and one checkpoint for all its runs."""

    def __init__(self, spark, path, kind):
        self.spark, self.path, self.kind, self.name = spark, path, kind, "f" + uuid.uuid4().hex
        (path / "in").mkdir()

    def add(self, rows):
        lines = [json.dumps(dict(zip([c.split()[0] for c in self.kind.split(", ")], [v.isoformat() if isinstance(v, datetime) else v for v in r]))) for r in rows]
        (self.path / "in" / f"{uuid.uuid4().hex}.json").write_text("\n".join(lines))

    def run(self, build):
        """What one start gives, and its last progress."""
        out = []
        stream = build(self.spark.readStream.schema(self.kind).json(str(self.path / "in")))
        q = stream.writeStream.foreachBatch(lambda df, _: out.extend(df.collect())).option("checkpointLocation", str(self.path / "checkpoint")).trigger(availableNow=True).start()
        uploads.wait(q, 120)
        return out, q.lastProgress


def at(hours, minutes=0):
    return datetime(2026, 1, 1) + timedelta(hours=hours, minutes=minutes)


def kept(progress):
    """State rows of brands, timers' rows left out."""
    return progress["stateOperators"][0]["numRowsTotal"]


def test_state_ends(spark, tmp_path):
    """A finished execution frees its state at once, a silent one when its time has passed; a restart goes on from the checkpoint."""
    uploads.keep_state_in_rocksdb(spark)
    feed = Feed(spark, tmp_path, KIND)
    step = lambda: feed.run(lambda s: uploads.suppress_running(s, timedelta(hours=6)))
    feed.add([("a", "status", "Executing", at(0)), ("b", "request", None, at(0)), ("b", "request", None, at(0, 1)), ("c", "status", None, at(0))])
    got, progress = step()
    assert sorted((r.brand, r.skipped) for r in got) == [("b", False), ("b", True)]
    assert kept(progress) > 0
    feed.add([("a", "request", None, at(1)), ("c", "request", None, at(1)), ("d", "request", None, at(1))])  # after a restart; c fails closed
    got, _ = step()
    assert sorted((r.brand, r.skipped) for r in got) == [("a", True), ("c", True), ("d", False)]
    feed.add([("a", "status", "Succeeded", at(2)), ("a", "request", None, at(2, 1)), ("a", "status", "Failed", at(2, 2))])
    got, _ = step()
    assert [(r.brand, r.skipped) for r in got] == [("a", False)]
    feed.add([("c", "request", None, at(6, 1)), ("d", "request", None, at(6, 59))])  # c's time has passed, d's hasn't
    got, _ = step()
    assert sorted((r.brand, r.skipped) for r in got) == [("c", False), ("d", True)]
    feed.add([("z", "status", "Stopped", at(40))])
    step()
    feed.add([("z", "status", "Stopped", at(41))])  # the watermark of the run before reaches everyone
    _, progress = step()
    assert kept(progress) == 0


def test_state_needs_rocksdb(spark, tmp_path):
    uploads.keep_state_in_rocksdb(spark)
    stream = spark.readStream.schema(KIND).json(str(tmp_path))
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(ValueError, match="keep_state_in_rocksdb"):
        uploads.suppress_running(stream)
    uploads.keep_state_in_rocksdb(spark)


def test_wait_by_a_given_clock():
    class Query:
        stopped, asked = False, 0

        def awaitTermination(self, seconds):
            self.asked += 1
            return False

        def stop(self):
            self.stopped = True

    q, now = Query(), iter(range(0, 1000, 10))
    with pytest.raises(TimeoutError, match="100 s"):
        uploads.wait(q, 100, clock=lambda: float(next(now)))
    assert q.stopped and 1 < q.asked < 10


PREDICTIONS = "endpoint string, brand_id string, ts timestamp, confidence double, corrected boolean"


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    """A batch whose signals were written before the stream broke off is run again after the restart; its rows are there once."""
    feed = Feed(spark, tmp_path, PREDICTIONS)
    out, checkpoint = str(tmp_path / "signals"), str(tmp_path / "checkpoint")
    released = [("b", "m1", "2026-01-01", 0.1)]
    rates = lambda: monitor.newest_rates(spark.createDataFrame(released, "brand string, model string, created_at string, rate double"))
    seen = []

    def run(fail=False):
        def then(number):
            seen.append(number)
            if fail:
                raise RuntimeError("lost after the write")

        stream = spark.readStream.schema(PREDICTIONS).json(str(tmp_path / "in"))
        q = monitor.monitor(stream, rates, out, checkpoint, "hourly", every=None, then=then)
        uploads.wait(q, 120)

    feed.add([("e1", "b", at(0), 0.9, False), ("e1", "b", at(0, 1), 0.8, True), ("e2", "b", at(0, 2), 0.66, False)])
    with pytest.raises(Exception, match="lost after the write"):
        run(fail=True)
    assert monitor.signals(spark, out).count() == 2
    run()
    rows = {r.endpoint: r for r in monitor.signals(spark, out).collect()}
    assert seen == [0, 0] and sorted(rows) == ["e1", "e2"]
    assert (rows["e1"].level, rows["e2"].level, rows["e1"].predictions) == (3, 1, 2) and rows["e1"].reasons == ["correction_rate_spike"] and rows["e1"].ts == at(0, 1)
    released.append(("b", "m2", "2026-01-02", 0.9))  # the newest baseline counts
    feed.add([("e1", "b", at(1), 0.9, False), ("e1", "b", at(1, 1), 0.8, True)])
    run()
    got = monitor.signals(spark, out).where("endpoint = 'e1'").orderBy("ts").collect()
    assert [r.level for r in got] == [3, 0] and [r.commit for r in got] == ["hourly-0", "hourly-1"]
    alarmed = {(r.endpoint, r.window_start): (r.level1, r.level2, r.level3) for r in monitor.alarms(spark, out).collect()}
    assert alarmed == {("e1", at(0)): (True, True, True), ("e2", at(0)): (True, False, False), ("e1", at(1)): (False, False, False)}
    feed.add([("e9", "unknown", at(2), 0.9, False)])
    with pytest.raises(Exception, match="no correction rate for unknown"):
        run()
