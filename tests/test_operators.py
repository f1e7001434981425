from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.config import Brand, Config, Drift, Evaluation, Quality, Selection
from sievework.functions import names, vectors
from sievework.operators import dedup, drift, evaluation, events, folds, gates, label_quality, reconcile, selection
from sievework.sources import readers, sinks

NOW = datetime(2026, 9, 16)


def inventory(spark, rows):
    return spark.createDataFrame(rows, "id string, key string, last_modified timestamp")


def base_rows():
    rows = [(f"wc-{x}-{i}", f"incoming/wc_{x}_0.9{i}.jpg", NOW - timedelta(days=i)) for x in ("fries", "burger") for i in range(3)]
    return rows + [("other", "bb_fries_0.9.jpg", NOW), ("old", "wc_fries_0.9.jpg", NOW - timedelta(days=400)), ("rare", "wc_salad_0.9.jpg", NOW)]


def test_selection_filters(spark):
    got = selection.select_curated(inventory(spark, base_rows()), Selection("wc_*", 6, 3, 6, 6), NOW).collect()
    assert len(got) == 6 and {r.label for r in got} == {"burger", "fries"}
    with pytest.raises(selection.SelectionError, match="below required minimum"):
        selection.select_curated(inventory(spark, base_rows()), Selection("wc_*", 6, 3, 7, 7), NOW)


def test_selection_cap_equals_round_robin(spark):
    rng = random.Random(7)
    for _ in range(3):
        sizes = {c: rng.randint(3, 12) for c in "abcd"}
        rows = [(f"{c}{i}", f"wc_{c}_0.{i:02d}.jpg", NOW) for c, n in sizes.items() for i in range(n)]
        cap = rng.randint(12, sum(sizes.values()))
        quota = {c: min(cap // 4, n) for c, n in sizes.items()}
        while sum(quota.values()) < cap:
            for c in sorted(sizes):
                if sum(quota.values()) < cap and quota[c] < sizes[c]:
                    quota[c] += 1
        got = selection.select_curated(inventory(spark, rows), Selection("wc_*", 1, 3, 1, cap), NOW).collect()
        assert Counter(r.label for r in got) == quota
        assert [r.id for r in got] == [f"{c}{i}" for c in sorted(quota) for i in range(quota[c])]


def test_selection_edges(spark):
    rows = [(f"{c}{i}", f"wc_{c}_0.{i:02d}.jpg", NOW) for c in "ab" for i in range(5)]
    with pytest.raises(selection.SelectionError, match="can't hold"):
        selection.select_curated(inventory(spark, rows), Selection("wc_*", 1, 4, 1, 7), NOW)
    at_cutoff = [(f"x{i}", f"wc_a_0.{i}.jpg", NOW - timedelta(days=30)) for i in range(2)]
    assert selection.select_curated(inventory(spark, at_cutoff), Selection("wc_*", 1, 1, 1, 5), NOW).count() == 2
    with pytest.raises(Exception, match="name is not"):
        selection.candidates(inventory(spark, [("b", "wc_broken.jpg", NOW)]), "wc_*", NOW, 1).collect()
    empty = selection.selection_metrics(selection.candidates(inventory(spark, []), "wc_*", NOW, 1)).first()
    assert empty.dataset_size == 0 and empty.minimum_class_count == 0


def test_names(spark):
    df = spark.createDataFrame([("a/wc_not_done_0.9.jpg",), ("wc_burger_0.95",)], "key string")
    strict = [r[0] for r in df.select(names.strict_parts(F.col("key"))).collect()]
    assert (strict[0].label, strict[0].confidence) == ("not_done", 0.9) and strict[1].confidence == 0.0
    assert df.select(names.lenient_parts(F.col("key")).label).first()[0] == "notdone"
    assert names.brand_token("wc_*") == "wc"
    with pytest.raises(ValueError):
        names.brand_token("*_x")
    g = spark.createDataFrame([("ab1",), ("abx",), ("ab\n",), ("Ab1",)], "n string")
    assert [r[0] for r in g.where(names.matches_glob(F.col("n"), "ab[!0-9]")).collect()] == ["abx", "ab\n"]
    assert [r[0] for r in g.where(names.matches_glob(F.col("n"), "a?1")).collect()] == ["ab1"]
    k = spark.createDataFrame([("a%20b+c",), ("%zz",)], "k string").select(names.decoded_key(F.col("k"))).collect()
    assert [r[0] for r in k] == ["a b c", "%zz"]
    c = spark.createDataFrame([('["x","y"]',), ("x; y,,z",)], "c string").select(names.split_claims(F.col("c"))).collect()
    assert [r[0] for r in c] == [["x", "y"], ["x", "y", "z"]]


def test_hash_embedding(spark):
    import hashlib

    rows = spark.createDataFrame([("one", b"same"), ("two", b"same"), ("three", b"else")], "id string, payload binary")
    got = {r.id: r.e for r in rows.select("id", vectors.hash_embedding(F.col("payload"), 1280).alias("e")).collect()}
    words = b"".join(hashlib.sha256(c.to_bytes(4, "big") + b"same").digest() for c in range(160))
    v = np.frombuffer(words, dtype=">u4").astype(float) / (2**32 - 1) * 2 - 1
    assert np.abs(np.array(got["one"]) - v / np.linalg.norm(v)).max() < 1e-9 and got["one"] == got["two"]
    kept = dedup.mark_near_duplicates(spark.createDataFrame([(i, got[k]) for i, k in enumerate(("one", "two", "three"))], "id long, embedding array<double>"), 0.999)
    assert {r.id for r in kept.where("NOT near_duplicate").collect()} == {0, 2}


def test_hash_embedding_equals_its_words(spark):
    """The numbers of the words' own expression to the bit, whatever the batches; a null payload has no vector."""
    rows = spark.createDataFrame([(i, None if i % 7 == 3 else bytes([i % 256]) * (i % 50)) for i in range(600)], "id long, payload binary").repartition(1)
    for width in (3, 8, 20):
        told = vectors.normalised(vectors.hash_words(F.col("payload"), width))
        got = rows.select("id", vectors.hash_embedding(F.col("payload"), width).alias("e"), told.alias("told")).collect()
        assert len(got) == 600 and all(r.e is None if r.id % 7 == 3 else r.e == r.told for r in got)


def test_keep_first_equals_sequential(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 4))
    x[5] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    for t in (0.9, 0.6):
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), dedup.FLOOR)
        kept: list[int] = []
        for i in range(len(x)):
            if not kept or (unit[kept] @ unit[i] < t).all():
                kept.append(i)
        got = dedup.mark_near_duplicates(df, t)
        assert sorted(r.id for r in got.where("NOT near_duplicate").collect()) == kept
    small = dedup.cosine_pairs(df, 0.9, block_rows=20).count()
    assert small == dedup.cosine_pairs(df, 0.9).count()


def blobs(n=8):
    rng = np.random.default_rng(2026)
    centres = rng.normal(size=(3, 16)) * 3
    return [(c * n + i, f"class-{c}", (centres[c] + rng.normal(size=16) * 0.25).tolist()) for c in range(3) for i in range(n)]


def test_folds_and_out_of_sample(spark):
    df = spark.createDataFrame(blobs(), "id long, label string, embedding array<double>")
    f = folds.stratified_folds(df, "label", "id", 4).collect()
    assert all(n == 2 for n in Counter((r.label, r.fold) for r in f).values())
    p = folds.out_of_sample(df, folds=4, trees=5, depth=3).collect()
    assert len(p) == 24 and all(abs(sum(r.pred_probs) - 1) < 1e-6 and min(r.pred_probs) >= 0 for r in p)
    assert sum(int(np.argmax(r.pred_probs)) == int(r.label[-1]) for r in p) >= 22
    with pytest.raises(ValueError, match="smallest class"):
        folds.fold_count(spark.createDataFrame([("a",)], "label string"), "label", 5)


def test_split(spark):
    df = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(10)], "label string, k int")
    n = Counter((r.label, r.split) for r in folds.train_val_split(df, "label", "k").collect())
    assert n == {("a", "val"): 1, ("a", "train"): 2, ("b", "val"): 2, ("b", "train"): 8}
    with pytest.raises(Exception, match="class of one row"):
        folds.train_val_split(spark.createDataFrame([("a", 1)], "label string, k int"), "label", "k").collect()


def test_label_quality(spark):
    rows = []
    for i in range(60):
        true = i % 3
        given = (true + 1) % 3 if i % 6 == 0 else true
        rows.append((i, str(given), [0.98 if j == true else 0.01 for j in range(3)], i % 6 == 0))
    df = spark.createDataFrame(rows, "id long, label string, pred_probs array<double>, injected boolean")
    issues = label_quality.prune_by_noise_rate(df, ["0", "1", "2"])
    flagged = label_quality.flag(df, ["0", "1", "2"], 0.5, issues)
    assert evaluation.recall_of_injected(flagged).first()[0] >= 0.8
    r = label_quality.report(flagged, 0.05).first()
    assert r.flagged_images + r.cleaned_count == 60 == r.total_images and abs(r.flagged_fraction - r.flagged_images / 60) < 1e-12
    assert {x.reason for x in flagged.where("flagged").collect()} <= {"mislabel", "ambiguous"}
    with pytest.raises(Exception, match="unknown label"):
        label_quality.confident_joint(df.withColumn("label", F.lit("9")), ["0", "1", "2"]).collect()
    assert label_quality.report(flagged.limit(0), 0.05).first().flagged_fraction == 0.0


def test_evaluation(spark):
    s = Evaluation(0.75, 0.25, least_samples=1, least_per_class=1)
    p = spark.createDataFrame([("done", "done", 0.9), ("done", "done", None), ("not_done", "done", 0.7), ("not_done", "not_done", 0.8)], "label string, prediction string, confidence double")
    m = evaluation.metrics(p, s)
    r = m.withColumn("g", evaluation.quality_gate(s)).first()
    assert (r.accuracy, r.emergency_false_positive_rate, r.g, r.confidence_summary["count"]) == (0.75, 0.5, "failed", 3)
    only = evaluation.metrics(p.where("label = 'done'"), s).withColumn("g", evaluation.quality_gate(s)).first()
    assert only.emergency_false_positive_rate is None and only.g == "failed"
    event = sinks.approval_event(evaluation.report(m, s), "b", "g", "m", "u", "s").select(F.json_object_keys("detail")).first()[0]
    assert len(event) == 9 and event == sorted(event)
    missing = spark.createDataFrame([("x",)], "image_path string")
    a = evaluation.with_aborts(evaluation.with_run_facts(m, missing, spark.createDataFrame([], "ms double")), s).first()
    assert a.accuracy == 0.0 and a.emergency_false_positive_rate == 1.0 and "missing images" in a.abort_reason


def test_gates_fail_closed(spark):
    g = gates.Gate("g", (gates.Condition("accuracy", ">=", 0.97),))
    for value, ok in ((0.97, True), (0.96, False), (None, False), (float("nan"), False)):
        assert g.evaluate(spark.createDataFrame([(value,)], "accuracy double")).first().passed is ok
    with pytest.raises(gates.GateFailed):
        g.require(spark.createDataFrame([], "accuracy double"))
    with pytest.raises(ValueError):
        gates.Condition("x", ">", 1)
    c = Config((Brand("wc", "wc_*"),), dict(recency_months=6, min_per_class=3, target_min=6, target_max=6))
    s = c.selection_of("wc")
    assert gates.check_literals([gates.dataset_bounds(s), gates.label_quality(c, s), gates.drift(c), gates.evaluation(c)]) == []
    assert gates.check_literals([gates.Gate("e", (gates.Condition("accuracy", ">=", 0.5),))], {"accuracy"}) != []
    with pytest.raises(ValueError):
        c.brand("nobody")


def test_drift(spark):
    df = spark.createDataFrame([(0.69, 0.10, 0.10), (0.64, 0.10, 0.10), (0.90, 0.31, 0.10), (0.9, 0.0, 0.0), (0.9, 0.1, 0.0)], "c double, r double, b double")
    level, reasons = drift.monitor_level(F.col("c"), F.col("r"), F.col("b"))
    got = df.select(level.alias("l"), reasons.alias("r")).collect()
    assert [r.l for r in got] == [1, 2, 3, 0, 3] and got[2].r == ["correction_rate_spike"]
    steps = spark.createDataFrame([(0.65, 3.0), (0.70, 1.0), (0.9, 3.0000001), (float("nan"), 1.0), (None, 1.0), (0.6999, 1.0)], "c double, m double")
    assert [r[0] for r in steps.select(drift.step_level(F.col("c"), F.col("m"))).collect()] == [1, 0, 2, 2, 2, 1]
    m = spark.createDataFrame([(0.3, 0.1), (0.3, 0.0), (float("inf"), 0.1), (None, 0.1)], "o double, b double").select(drift.multiplier(F.col("o"), F.col("b"))).collect()
    assert abs(m[0][0] - 3) < 1e-9 and all(r[0] == drift.UNMEASURED for r in m[1:])
    assert drift.mean_confidence(spark.createDataFrame([], "pred_probs array<double>")).first().confidence_measured is False
    with pytest.raises(ValueError):
        Drift(level1_floor=0.9)
    with pytest.raises(ValueError):
        Quality(cosine_threshold=0)


def test_reconcile(spark):
    heads = spark.createDataFrame([("a", "s1", None), ("b", None, '"e"'), ("c", "s3", None), ("d", "s4", None)], "key string, sha string, etag string")
    src = heads.withColumn("c", reconcile.checksum(F.col("sha"), F.col("etag"), F.col("key"))).select("key", "c.*")
    dst = spark.createDataFrame([("a", "SHA256", "s1"), ("b", "ETag", "e"), ("c", "ETag", "s3")], "key string, algorithm string, value string")
    r = {x.key: (x.matched, x.reason) for x in reconcile.reconcile(src, dst).collect()}
    assert r == {"a": (True, None), "b": (True, None), "c": (False, "algorithm"), "d": (False, "missing")}
    with pytest.raises(reconcile.ChecksumMismatch, match="first c"):
        reconcile.require_all(reconcile.reconcile(src, dst))
    with pytest.raises(Exception, match="no checksum"):
        heads.withColumn("sha", F.lit(None).cast("string")).select(reconcile.checksum(F.col("sha"), F.col("etag"), F.col("key"))).collect()


def test_events(spark):
    raw = spark.createDataFrame([
        (0, '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"raw/wc_burger%20image.jpg"}}},{"s3":{"bucket":{"name":"b"}}}]}'),
        (1, '{"detail":{"bucket":{"name":"b"},"object":{"key":"raw/zz_x.jpg"}}}'),
        (2, '{"detail":{"bucket":{"name":"b"},"object":{"key":"wc_2.jpg"}}}'),
    ], "n int, value string")
    rows = events.uploads(raw)
    assert [r.key for r in rows.orderBy("n").collect()] == ["raw/wc_burger image.jpg", "raw/zz_x.jpg", "wc_2.jpg"]
    one = events.coalesced(events.with_brand(rows, [("wc", "wc_*"), ("all", "wc*")]), "n").collect()
    assert [(r.brand, r.key, r.coalesced_count) for r in one] == [("wc", "raw/wc_burger image.jpg", 2)]
    many = spark.createDataFrame([(f"b{i:02d}", i) for i in range(15)], "brand string, n int")
    sizes: list[int] = []
    assert events.publish(many, "brand", lambda batch: sizes.append(len(batch)) or 1) == (13, 2) and sizes == [10, 5]
    running = spark.createDataFrame([("b00", "Executing"), ("b01", "Failed")], "brand string, status string")
    assert [r.brand for r in events.suppressed(many, running).where("skipped").collect()] == ["b00"]
    assert events.suppressed(many, None).where("NOT skipped").count() == 0
    assert [events.window_seconds(x) for x in ("60", "x", -1, None)] == [60, 300, 300, 300]


def test_readers(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"label":"a","prediction":"a","confidence":0.5}\n\n{"label":"a","prediction":"b"}\n')
    assert [r.confidence for r in readers.predictions(spark, str(tmp_path / "p.jsonl")).collect()] == [0.5, None]
    (tmp_path / "bad.jsonl").write_text('{"label":"a"}\n')
    with pytest.raises(Exception, match="needs label and prediction"):
        readers.predictions(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "empty.jsonl").write_text("\n")
    with pytest.raises(ValueError):
        readers.predictions(spark, str(tmp_path / "empty.jsonl"))
    for name in ("a/x.JPG", "b/y.png", "b/z.txt"):
        (tmp_path / "img" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "img" / name).write_bytes(name.encode())
    assert {r.label for r in readers.labelled_files(spark, str(tmp_path / "img")).collect()} == {"a", "b"}
    np.save(tmp_path / "m.npy", np.eye(3, dtype=np.float32))
    assert readers.matrix(spark, str(tmp_path / "m.npy")).count() == 3
    for body, reason in (('{"observed_correction_rate":0.3,"baseline_correction_rate":0.1}', None), ('{"observed_correction_rate":0.3}', "field_missing"), ('{"observed_correction_rate":"x","baseline_correction_rate":1}', "not_a_number"), ('{"observed_correction_rate":1,"baseline_correction_rate":0}', "baseline_zero")):
        (tmp_path / "r.json").write_text(body)
        assert readers.correction_rate(spark, str(tmp_path / "r.json")).first().reason == reason
    c = spark.createDataFrame([("d/epoch-2.weights.h5",), ("d/epoch-10.weights.h5",), ("d/other",)], "path string")
    assert readers.latest_checkpoint(c).first().epoch == 10


@pytest.mark.parametrize("task_rows", [0, folds.TASK_ROWS])
def test_ranks_across_parts(spark, monkeypatch, task_rows):
    """A class that lies in many parts is ranked as one; null classes too."""
    monkeypatch.setattr(folds, "TASK_ROWS", task_rows)
    rows = [(i, "hot" if i % 5 else ("rare" if i % 2 else None)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label string").repartition(7)
    got = {r.id: (r._rank, r._n) for r in folds.ranked(df, "label", F.col("id")).collect()}
    for label in ("hot", "rare", None):
        own = sorted(i for i, x in rows if x == label)
        assert [got[i] for i in own] == [(k + 1, len(own)) for k in range(len(own))]


def test_imports_by_position(spark):
    labels, rows = (spark.createDataFrame([(i, v) for i, v in enumerate(x)], f"position long, {c}") for x, c in ((["a", "b"], "label string"), ([[0.1], [0.9]], "vector array<double>")))
    assert [(r.position, r.label, r.vector) for r in readers.by_position(labels, rows).orderBy("position").collect()] == [(0, "a", [0.1]), (1, "b", [0.9])]
    with pytest.raises(Exception, match="position 1"):
        readers.by_position(labels, rows.limit(1)).collect()


def test_prediction_lines(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"label":"a","prediction":"a"}\n\n{"label":"a"}\n')
    with pytest.raises(ValueError, match="p.jsonl, line 3"):
        readers.predictions(spark, str(tmp_path / "p.jsonl"))


def test_names_and_relaxed_settings():
    from sievework import config

    assert config.missing(("a", "b"), {"b": 1}) == ["a"] and config.forbidden(("a", "b"), {"b", "c"}) == ["b"]
    floors = {"accuracy": (">=", 0.97)}
    assert config.check_relaxed({"accuracy": 0.98}, floors, "run", "run") == []
    with pytest.raises(ValueError, match="acknowledged"):
        config.check_relaxed({"accuracy": 0.5}, floors, "smoke", "run")
    with pytest.raises(ValueError, match="can't be named"):
        config.check_relaxed({"accuracy": 0.5}, floors, "run", "run", True)
    assert config.check_relaxed({"accuracy": 0.5}, floors, "smoke", "run", True) == ["accuracy"]


def test_running_executions(spark):
    runs = spark.createDataFrame([("b", "Executing", "e1", 1), ("b", "Executing", "e2", 2), ("b", "Succeeded", "e3", 3), ("c", "Failed", "e4", 4)], "brand string, status string, execution_id string, started_at long")
    got = {r.brand: (r.skipped, r.execution_id) for r in events.suppressed(spark.createDataFrame([("b",), ("c",)], "brand string"), runs).collect()}
    assert got == {"b": (True, "e2"), "c": (False, None)} and [r.execution_id for r in events.newest_first(runs).collect()] == ["e4", "e3", "e2", "e1"]


def test_files_and_names_that_steps_look_up(spark, tmp_path):
    """Listings, digests and paths of files, labels and names, each against plain Python."""
    import hashlib

    for name in ("a/x_done_0.9.jpg", "a/y.jpg", "b/z.JPG", "note.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    root = str(tmp_path)
    digests = {r.path.removeprefix(f"file:{root}/"): r.sha256 for r in readers.file_digests(spark, root).collect()}
    assert digests == {n: hashlib.sha256(n.encode()).hexdigest() for n in ("a/x_done_0.9.jpg", "a/y.jpg", "b/z.JPG", "note.txt")}
    now = datetime(2026, 1, 1)
    flat = readers.flat_listing(spark, f"{root}/a", F.lit(now))
    assert sorted((r.id, r.key, r.last_modified) for r in flat.collect()) == [("x_done_0.9.jpg", "x_done_0.9.jpg", now), ("y.jpg", "y.jpg", now)]
    labelled = readers.labelled_files(spark, root)
    assert sorted(r.label for r in labelled.collect()) == ["a", "a", "b"]
    assert not readers.same_classes(labelled, labelled.where("label = 'a'")) and readers.same_classes(labelled, labelled.distinct())
    manifest = spark.createDataFrame([("1", "k1", None), ("2", "k2", "p2"), ("3", None, None)], "id string, key string, image_path string")
    found = readers.resolved(manifest, spark.createDataFrame([("k1",), ("p2",), ("2",), ("k1",)], "path string"))
    assert sorted(r.id for r in found.collect()) == ["1", "2"]
    row = spark.createDataFrame([("in/wc_not_done_0.9.tar.gz", None, "b", "c")], "key string, x string, y string, z string")
    told = row.select(sinks.file_stem(F.col("key")).alias("stem"), names.second_part(F.col("key")).alias("second"), names.with_fallback(F.col("x"), F.col("y"), F.col("z")).alias("some")).first()
    assert tuple(told) == ("wc_not_done_0.9.tar", "not", "b")
    body = spark.createDataFrame([('{"a":1,"z":2,"b":3}', '["x","y"]', "y; w , ")], "body string, one string, two string")
    seen = body.select(events.unexpected_fields(F.col("body"), ["a", "b"]).alias("extra"), events.allowed_brands(F.col("one"), F.col("two"), F.lit(None).cast("string")).alias("brands")).first()
    assert seen.extra == ["z"] and sorted(seen.brands) == ["w", "x", "y"]
