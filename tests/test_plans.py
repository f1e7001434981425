from __future__ import annotations

import subprocess
import sys
import uuid
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.config import Brand, Config, Evaluation, Quality
from sievework.operators.gates import GateFailed
from sievework.plans import curation, registry
from sievework.streaming import uploads
from tests.conftest import ROOT

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    import pandas as pd

    cols = sorted(frame.columns)

    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if isinstance(x, (str, bool)) or type(x).__name__ == "bool":
            return str(x)
        return float(x)

    return cols, sorted(repr(tuple(map(plain, r))) for r in frame[cols].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_sql(spark, name):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = rows_of(registry.queries()[name](spark, SF).toPandas())
    assert got == rows_of(con.sql(registry.oracle_sql()[name]).df())
    assert got[1]


def test_full_size_queries(spark, monkeypatch):
    """Queries without SQL run at the operators' whole size."""
    import hashlib
    import inspect

    asked = {}
    whole = registry.folds.out_of_sample
    monkeypatch.setattr(registry.folds, "out_of_sample", lambda rows, **k: asked.update(k) or whole(rows, folds=2, trees=2, depth=2))
    registry.queries()["kfold_oos_rf"](spark, SF)
    assert asked == {n: inspect.signature(whole).parameters[n].default for n in ("folds", "trees", "depth")}
    texts = {r.doc_id: r.text for r in registry.table(spark, SF, "documents").collect()}
    got = {r.doc_id: r.embedding for r in registry.queries()["hash_embedding_full"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        words = b"".join(hashlib.sha256(c.to_bytes(4, "big") + text.encode()).digest() for c in range(160))
        v = np.frombuffer(words, dtype=">u4").astype(float) / (2**32 - 1) * 2 - 1
        assert np.abs(np.array(got[i]) - v / np.linalg.norm(v)).max() < 1e-9


def test_curation_run(spark, tmp_path):
    rng = np.random.default_rng(1)
    now = datetime(2026, 1, 1)
    inv = spark.createDataFrame([(str(i), f"wc_{'done' if i % 2 else 'not_done'}_0.{i:02d}.jpg", now) for i in range(80)], "id string, key string, last_modified timestamp")
    payloads = spark.createDataFrame([(str(i), bytes([i % 2])) for i in range(80)], "id string, payload binary")
    rates = spark.createDataFrame([(0.1, 0.1)], "observed double, baseline double")
    vec = {i: (rng.normal(size=4) * 0.1 + (3 if i % 2 else -3)).tolist() for i in range(80)}
    table = spark.createDataFrame([(str(i), v) for i, v in vec.items()], "id string, embedding array<float>")
    embed = lambda df: df.join(table, "id").withColumn("embedding_backend", F.lit("efficientnet"))
    c = Config((Brand("wc", "wc_*", "group"),), dict(recency_months=6, min_per_class=2, target_min=4, target_max=100), Quality(0.05, 0.5, 1.0, 4), Evaluation(least_samples=1, least_per_class=1))
    done = curation.run(inv, payloads, rates, c, "wc", now, str(tmp_path), embed, "m1", trees=5, depth=3)
    assert done.registry.first().approval_status == "PendingManualApproval" and done.report.first().quality_gate == "passed"
    with pytest.raises(GateFailed, match="EmbeddingBackend"):
        curation.run(inv, payloads, rates, c, "wc", now, str(tmp_path), curation.hash_embedder(16), "m1")


def test_curation_evaluates_all_rows(spark, tmp_path):
    """Every cleaned row is scored, with its probability and time; a missing file or a slow model fails the run."""
    rng = np.random.default_rng(1)
    now = datetime(2026, 1, 1)
    inv = spark.createDataFrame([(str(i), f"wc_{'done' if i % 2 else 'not_done'}_0.{i:02d}.jpg", now) for i in range(80)], "id string, key string, last_modified timestamp")
    payloads = spark.createDataFrame([(str(i), bytes([i % 2])) for i in range(80)], "id string, payload binary")
    rates = spark.createDataFrame([(0.1, 0.1)], "observed double, baseline double")
    table = spark.createDataFrame([(str(i), (rng.normal(size=4) * 0.1 + (3 if i % 2 else -3)).tolist()) for i in range(80)], "id string, embedding array<float>")
    embed = lambda df: df.join(table, "id").withColumn("embedding_backend", F.lit("efficientnet"))

    def run(name, files, **settings):
        c = Config((Brand("wc", "wc_*", "group"),), dict(recency_months=6, min_per_class=2, target_min=4, target_max=100), Quality(0.05, 0.5, 1.0, 4), Evaluation(**settings))
        return curation.run(inv, files, rates, c, "wc", now, str(tmp_path / name), embed, "m1", trees=5, depth=3)

    done = run("whole", payloads, least_samples=60, least_per_class=30)
    m, cleaned = done.report.first().metrics, done.flagged.where("NOT flagged").count()
    assert m.sample_count == cleaned >= 60 and m.confidence_summary["count"] == cleaned and 0.5 <= m.confidence_summary["min"] <= m.confidence_summary["max"] <= 1
    facts = spark.read.json(str(tmp_path / "whole" / "evaluation_metrics")).first()
    assert facts.missing_images == 0 and 0 < facts.latency_ms < 1000
    with pytest.raises(GateFailed, match="missing_images <= 0"):
        run("missing", payloads.withColumn("payload", F.when(F.col("id") != "7", F.col("payload"))).where("id <> '9'"), least_samples=1, least_per_class=1)
    facts = spark.read.json(str(tmp_path / "missing" / "evaluation_metrics")).first()
    assert facts.missing_images == 2 and "missing images" in facts.abort_reason and facts.accuracy == 0.0
    with pytest.raises(GateFailed, match="latency_ms <="):
        run("slow", payloads, least_samples=1, least_per_class=1, latency_ms=1e-6)


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join('{"detail":{"bucket":{"name":"b"},"object":{"key":"wc_%d.jpg"}}}' % i for i in range(5)))
    sent: list[dict] = []
    stream = spark.readStream.text(str(src)).withColumn("ts", F.lit("2026-01-01 00:00:10").cast("timestamp"))
    from sievework.operators import events

    def batch(df, _):
        events.publish(events.coalesced(events.with_brand(events.uploads(df), [("wc", "wc_*")]), "key"), "brand", lambda b: sent.extend(b) or 0)

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    uploads.wait(q, 120)
    assert [(r["brand"], r["coalesced_count"]) for r in sent] == [("wc", 5)]
    out = uploads.requests(stream, [("wc", "wc_*")])
    q = out.writeStream.format("memory").queryName("req").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    uploads.wait(q, 120)
    assert [(r.brand, r.coalesced_count) for r in spark.table("req").collect()] == [("wc", 5)]


def test_saved_model_and_registration(spark, tmp_path):
    """Loaded again, the saved model predicts; the registration's result names it."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.linalg import Vectors

    now = datetime(2026, 1, 1)
    inv = spark.createDataFrame([(str(i), f"wc_{'done' if i % 2 else 'not_done'}_0.{i:02d}.jpg", now) for i in range(40)], "id string, key string, last_modified timestamp")
    payloads = spark.createDataFrame([(str(i), bytes([i % 2])) for i in range(40)], "id string, payload binary")
    table = spark.createDataFrame([(str(i), [3.0 + i / 99 if i % 2 else -3.0, i / 7, 1.0]) for i in range(40)], "id string, embedding array<float>")
    embed = lambda df: df.join(table, "id").withColumn("embedding_backend", F.lit("efficientnet"))
    c = Config((Brand("wc", "wc_*", "group"),), dict(recency_months=6, min_per_class=2, target_min=4, target_max=100), Quality(0.05, 0.5, 1.0, 2), Evaluation(least_samples=1, least_per_class=1))
    curation.run(inv, payloads, spark.createDataFrame([(0.1, 0.1)], "observed double, baseline double"), c, "wc", now, str(tmp_path), embed, "m1", trees=3, depth=2)
    result = spark.read.json(str(tmp_path / "registration" / "wc" / "m1")).first()
    assert (result.model, result.approval_status) == ("m1", "PendingManualApproval")
    model = RandomForestClassificationModel.load(result.model_uri)
    assert [model.predict(Vectors.dense(x, 1.0, 1.0)) for x in (3.0, -3.0)] == [0.0, 1.0]


def test_stateful_streams(spark, tmp_path):
    def run(rows, kind, build, mode="append"):
        src = tmp_path / uuid.uuid4().hex
        spark.createDataFrame(rows, kind).coalesce(1).write.json(str(src))
        name = "s" + uuid.uuid4().hex
        q = build(spark.readStream.schema(kind).json(str(src))).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(src) + "-cp").trigger(availableNow=True).start()
        uploads.wait(q, 120)
        return spark.table(name)

    at = lambda m: datetime(2026, 1, 1, 0, m)
    uploads.keep_state_in_rocksdb(spark)
    rows = [("b", "request", None, at(1)), ("b", "status", "Succeeded", at(3)), ("b", "request", None, at(2)), ("b", "request", None, at(4)), ("c", "request", None, at(1))]
    got = run(rows, "brand string, kind string, status string, ts timestamp", uploads.suppress_running)
    assert sorted((r.brand, r.skipped) for r in got.collect()) == [("b", False), ("b", False), ("b", True), ("c", False)]
    got = run([("b", at(1)), ("b", at(2)), ("b", at(7)), ("c", at(1))], "brand string, ts timestamp", uploads.once_a_window)
    assert sorted((r.brand, r.window_number % 12) for r in got.collect()) == [("b", 0), ("b", 1), ("c", 0)]
    got = run([("e", 1, at(1)), ("e", 3, at(2)), ("e", 0, at(7))], "endpoint string, level int, ts timestamp", uploads.alarms, "complete")
    assert sorted((r.level, r.level1, r.level2, r.level3) for r in got.collect()) == [(0, False, False, False), (3, True, True, True)]
    got = run([("b", at(1)), ("b", at(20)), ("b", at(59))], "brand string, ts timestamp", uploads.sessions, "complete")
    assert sorted(r.n for r in got.collect()) == [1, 2]


def test_entry_without_llm():
    """The entry module works where the training-data operators aren't installed."""
    code = "import sys; sys.modules['sievework.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 25 and int(out[1]) >= 25
