"""Tables and files that runs write, one after another and once more."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators import evaluation
from sievework.sources import keyed, sinks

KIND = T.StructType([T.StructField("brand", T.StringType()), T.StructField("model", T.StringType()), T.StructField("n", T.IntegerType())])


def rows(spark, *values):
    return spark.createDataFrame(list(values), KIND)


def test_other_keys_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert keyed.read(spark, path, KIND).count() == 0
    keyed.replace(rows(spark, ("007", "m1", 1), ("b", "m1", 2)), path, ("brand", "model"))
    keyed.replace(rows(spark, ("007", "m2", 3), ("b", "m1", 4), ("b", "m1", 5)), path, ("brand", "model"))
    keyed.replace(rows(spark), path, ("brand", "model"))
    got = sorted((r.brand, r.model, r.n) for r in keyed.read(spark, path, KIND).collect())
    assert got == [("007", "m1", 1), ("007", "m2", 3), ("b", "m1", 4), ("b", "m1", 5)]
    with pytest.raises(Exception, match="a key of brand, model is null"):
        keyed.replace(rows(spark, (None, "m", 1)), path, ("brand", "model"))
    assert keyed.read(spark, path, KIND).count() == 4


def test_a_commit_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for commit, n in (("r1", 1), ("r2", 2), ("r1", 1), ("a/b 1", 3)):
        keyed.append_once(rows(spark, ("b", "m", n), ("b", f"m{n}", n)), path, commit)
    got = keyed.read(spark, path, KIND)
    assert sorted((r.commit, r.model, r.n) for r in got.collect()) == [("a/b 1", "m", 3), ("a/b 1", "m3", 3), ("r1", "m", 1), ("r1", "m1", 1), ("r2", "m", 2), ("r2", "m2", 2)]
    assert sorted((r.model, r.n) for r in keyed.latest(got, ("brand", "model"), "n").collect()) == [("m", 3), ("m1", 1), ("m2", 2), ("m3", 3)]
    tied = keyed.latest(got.withColumn("n", F.lit(1)), ("brand", "model"), "n").where("model = 'm'").first()
    assert tied.commit == "r2"
    with pytest.raises(ValueError):
        keyed.append_once(rows(spark), path, "")


def test_two_brands_and_models_under_one_folder(spark, tmp_path):
    predictions = spark.createDataFrame([("done", "done", 0.9), ("not_done", "done", 0.8)], "label string, prediction string, confidence double")
    report = evaluation.report(evaluation.metrics(predictions))
    out = str(tmp_path)
    for brand, model, at in (("a", "m1", "2026-01-01"), ("b", "m1", "2026-01-02"), ("a", "m2", "2026-01-03"), ("a", "m1", "2026-01-01")):
        sinks.register(sinks.registration(brand, f"group-{brand}", model, report, at), sinks.baseline(report, brand, model, at), out, f"{brand}-{model}")
    assert keyed.read(spark, f"{out}/registry", sinks.REGISTRY).count() == 3
    got = sorted((r.brand, r.model, r.version, r.approval_status, r.quality_gate) for r in sinks.registered(spark, out).collect())
    assert got == [("a", "m1", 1, "PendingManualApproval", "failed"), ("a", "m2", 2, "PendingManualApproval", "failed"), ("b", "m1", 1, "PendingManualApproval", "failed")]
    base = sorted(sinks.baselines(spark, out).collect(), key=lambda r: (r.brand, r.model))
    assert [(r.brand, r.model, r.created_at) for r in base] == [("a", "m1", "2026-01-01"), ("a", "m2", "2026-01-03"), ("b", "m1", "2026-01-02")]
    assert base[0].sample_count == 2 and base[0].label_distribution == {"done": 1, "not_done": 1} and base[0].quality_metrics.done_when_not_done_fp_rate == 1.0
    assert base[0].confidence["count"] == 2
