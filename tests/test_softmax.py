"""The softmax head: its gradient, its checkpoints, and runs that break off."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.config import Brand, Config, Evaluation, Quality
from sievework.operators import softmax
from sievework.plans import curation
from sievework.sources import readers

KIND = "id long, label string, embedding array<float>, split string"


def frame(spark, n=90, width=5, seed=1):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % 3
    x = rng.normal(size=(3, width))[y] * 2 + rng.normal(size=(n, width))
    return spark.createDataFrame([(i, f"c{c}", v.tolist(), "val" if i % 5 == 0 else "train") for i, (v, c) in enumerate(zip(x, y))], KIND), x.astype(np.float32), y


def test_gradient_equals_differences(spark):
    d, x, y = frame(spark, 30)
    table = d.select(F.substring("label", 2, 1).cast("int").alias("y"), (F.col("split") == "train").alias("training"), F.spark_partition_id().alias("part"), "embedding").toPandas()
    table["x"] = [np.asarray(v, dtype="<f4").tobytes() for v in table["embedding"]]
    table = spark.createDataFrame(table[["y", "training", "part", "x"]], "y int, training boolean, part int, x binary")
    w = np.random.default_rng(2).normal(size=(3, 6))
    sums = softmax._sums(table, w)
    train = np.arange(30) % 5 != 0
    assert sums["training"][0] == train.sum() and sums["validation"][0] == (~train).sum()

    def loss(w):
        p = softmax.probabilities(w, x[train].astype(float))
        return -np.log(p[np.arange(train.sum()), y[train]]).sum()

    assert sums["training"][1] == pytest.approx(loss(w))
    for i, j in ((0, 0), (1, 5), (2, 3)):
        step = np.zeros_like(w)
        step[i, j] = 1e-5
        assert sums["gradient"][i, j] == pytest.approx((loss(w + step) - loss(w - step)) / 2e-5, rel=1e-5)


def test_an_interrupted_run_ends_like_an_unbroken_one(spark, tmp_path):
    d, _, _ = frame(spark)
    whole, told = softmax.train(d.repartition(3), str(tmp_path / "a"), settings=softmax.Settings(epochs=12, every=5))
    assert (told["resumed_from_epoch"], told["final_epoch"]) == (0, 12) and told["metrics"]["accuracy"] > 0.8 and told["history"] == sorted(told["history"], reverse=True)
    softmax.train(d.repartition(3), str(tmp_path / "b"), settings=softmax.Settings(epochs=7, every=5))  # broken off after epoch 7, saved at 5
    again, told = softmax.train(d.repartition(3), str(tmp_path / "b"), settings=softmax.Settings(epochs=12, every=5))
    assert (told["resumed_from_epoch"], told["final_epoch"]) == (5, 12) and np.array_equal(whole.weights, again.weights)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "b")).select("path")
    assert readers.latest_checkpoint(listing).first()["epoch"] == 10
    done, told = softmax.train(d, str(tmp_path / "b"), settings=softmax.Settings(epochs=10, every=5))
    assert (told["resumed_from_epoch"], told["final_epoch"]) == (10, 10)
    with pytest.raises(ValueError, match="of the classes"):
        softmax.train(d.withColumn("label", F.concat("label", F.lit("x"))), str(tmp_path / "b"), settings=softmax.Settings(epochs=11))


def test_stops_on_nan(spark, tmp_path):
    d, _, _ = frame(spark)
    bad = d.withColumn("embedding", F.when(F.col("id") == 7, F.transform("embedding", lambda x: F.lit(float("nan")).cast("float"))).otherwise(F.col("embedding")))
    head, told = softmax.train(bad, str(tmp_path), settings=softmax.Settings(epochs=6, every=1))
    assert told["stopped_on_nan"] and told["final_epoch"] == 0 and np.isfinite(head.weights).all() and softmax.load_checkpoint(spark, str(tmp_path), head.classes) is None


def test_saved_head_and_odd_rows(spark, tmp_path):
    d, x, _ = frame(spark)
    odd = spark.createDataFrame([(500, None, [0.0] * 5, "train"), (501, "c1", None, "val")], KIND)
    head, _ = softmax.train(d.unionByName(odd), str(tmp_path / "c"), settings=softmax.Settings(epochs=3))
    head.save(spark, str(tmp_path / "model"))
    back = softmax.Head.load(spark, str(tmp_path / "model"))
    assert back.classes == ["c0", "c1", "c2"] and np.array_equal(back.weights, head.weights)
    got = {r.id: r for r in back.transform(d).collect()}
    assert np.allclose([got[i].probability for i in range(90)], softmax.probabilities(head.weights, x.astype(float))) and all(0 <= r.ms < 1000 for r in got.values())
    assert all(r.prediction == f"c{int(np.argmax(r.probability))}" for r in got.values())
    with pytest.raises(ValueError, match="same classes"):
        softmax.train(d.where("label <> 'c1' OR split = 'train'"), str(tmp_path / "d"))
    with pytest.raises(ValueError, match="one width"):
        softmax.train(d.unionByName(spark.createDataFrame([(502, "c1", [1.0], "val")], KIND)), str(tmp_path / "d"))


def test_curation_run_with_a_head(spark, tmp_path):
    now = datetime(2026, 1, 1)
    inv = spark.createDataFrame([(str(i), f"wc_{'done' if i % 2 else 'not_done'}_0.{i:02d}.jpg", now) for i in range(40)], "id string, key string, last_modified timestamp")
    payloads = spark.createDataFrame([(str(i), bytes([i % 2])) for i in range(40)], "id string, payload binary")
    table = spark.createDataFrame([(str(i), [3.0 + i / 99 if i % 2 else -3.0, i / 70, 1.0]) for i in range(40)], "id string, embedding array<float>")
    embed = lambda df: df.join(table, "id").withColumn("embedding_backend", F.lit("efficientnet"))
    c = Config((Brand("wc", "wc_*", "group"),), dict(recency_months=6, min_per_class=2, target_min=4, target_max=100), Quality(0.05, 0.5, 1.0, 2), Evaluation(least_samples=1, least_per_class=1))
    rates = spark.createDataFrame([(0.1, 0.1)], "observed double, baseline double")
    curation.run(inv, payloads, rates, c, "wc", now, str(tmp_path), embed, "m1", trees=3, depth=2, head="softmax", training=softmax.Settings(epochs=12, rate=0.2))
    told = json.loads(spark.read.text(str(tmp_path / "models/wc/m1/training_metrics")).first()[0])
    assert told["brand_id"] == "wc" and told["final_epoch"] == 12 and told["class_names"] == ["done", "not_done"] and told["metrics"]["val_accuracy"] == 1.0
    assert softmax.Head.load(spark, str(tmp_path / "models/wc/m1")).classes == ["done", "not_done"]
    facts = spark.read.json(str(tmp_path / "evaluation_metrics")).first()
    assert 0 <= facts.latency_ms < 100
