"""Matrices, class folders and images, written by the tests and read through Spark's sources."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators.reconcile import CountMismatch, counts_agree
from sievework.plans import stores
from sievework.sources import folders, images, npy, readers


def test_matrix_in_partitions(spark, tmp_path):
    m = np.arange(5000 * 8, dtype=np.float64).reshape(5000, 8)
    np.save(tmp_path / "a.npy", m)
    np.save(tmp_path / "b.npy", m[:10].astype(np.int16))
    one = npy.read(spark, str(tmp_path / "a.npy"), 64 * 100)
    assert one.rdd.getNumPartitions() == 50
    got = one.orderBy("position").collect()
    assert [r.position for r in got] == list(range(5000)) and np.array_equal(np.array([r.vector for r in got]), m.astype(np.float32))
    assert sorted(map(tuple, one.select("position", "vector").limit(5000).collect())) == sorted(map(tuple, readers.matrix(spark, str(tmp_path / "a.npy")).collect()))
    both = npy.read(spark, f"file://{tmp_path}")
    assert both.count() == 5010 and both.where("file like '%b.npy'").agg(F.min("position"), F.max("position")).first() == (5000, 5009)
    m.astype(np.float32).tofile(tmp_path / "raw")
    parquet = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "position long, vector array<float>")
    assert parquet.exceptAll(one.select("position", "vector")).count() == 0


def test_position_prunes_partitions(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.zeros((5000, 8)))
    before = spark.conf.get(npy.PUSHDOWN)
    try:
        spark.conf.set(npy.PUSHDOWN, "true")
        rows = npy.read(spark, str(tmp_path / "a.npy"), 64 * 100)
        for where, partitions, count in (("position >= 4850", 2, 150), ("position < 101", 2, 101), ("position = 7", 1, 1), ("position > 99 and position <= 199", 1, 100), ("position > 9999", 1, 0)):
            part = rows.where(where)
            assert part.rdd.getNumPartitions() <= partitions and part.count() == count
    finally:
        spark.conf.set(npy.PUSHDOWN, before)


@pytest.mark.parametrize("bad", ["vector", "columns", "object", "short", "magic", "absent"])
def test_bad_matrices(spark, tmp_path, bad):
    path = tmp_path / "m.npy"
    m = np.arange(12.0).reshape(3, 4)
    np.save(path, {"vector": m[0], "columns": np.asfortranarray(m), "object": np.array([[None]]), "short": m, "magic": m, "absent": m}[bad], allow_pickle=True)
    if bad == "short":
        path.write_bytes(path.read_bytes()[:-8])
    if bad == "magic":
        path.write_bytes(b"not a matrix at all")
    if bad == "absent":
        path.unlink()
    with pytest.raises(Exception, match="isn't a matrix|too few|magic|m.npy"):
        npy.read(spark, str(path)).count()


def test_matrix_written(spark, tmp_path):
    npy.register(spark)
    df = spark.range(0, 1000, 1, 4).select(F.array(F.col("id").cast("float"), F.lit(1.5).cast("float")).alias("vector"))
    df.write.format("npy").mode("append").save(str(tmp_path / "m"))
    got = npy.read(spark, str(tmp_path / "m")).orderBy("position").collect()
    assert [r.vector for r in got] == [[float(i), 1.5] for i in range(1000)] and len({r.file for r in got}) == 4
    with pytest.raises(Exception, match="exists"):
        df.write.format("npy").mode("append").save(str(tmp_path / "m"))
    df.limit(3).coalesce(1).write.format("npy").mode("overwrite").save(str(tmp_path / "m"))
    assert npy.read(spark, str(tmp_path / "m")).count() == 3
    with pytest.raises(Exception, match="without nulls"):
        df.select(F.array(F.lit(None).cast("float")).alias("vector")).write.format("npy").mode("append").save(str(tmp_path / "n"))
    assert sorted(os.listdir(tmp_path)) == ["m"]


def manifest(spark, n, payload="payload"):
    rows = [("train" if i % 4 else "validation", f"label {i % 3}", f"a/{i}/x.jpg", f"a/{i}/x.JPG", bytes([i % 256]) * (i + 1)) for i in range(n)]
    return spark.createDataFrame(rows, f"split string, label string, id string, key string, {payload} binary").repartition(3)


def test_class_folders(spark, tmp_path):
    rows, out = manifest(spark, 60), tmp_path / "out"
    folders.write(rows, str(out))
    expected = {(r.split, r.label, hashlib.sha1(r.id.encode()).hexdigest()[:16] + ".JPG"): bytes(r.payload) for r in rows.collect()}
    found = {(d.split("/")[-2], d.split("/")[-1], f): open(f"{d}/{f}", "rb").read() for d, _, names in os.walk(out) for f in names if not f.startswith("_")}
    assert found == expected
    listed = folders.listing(spark, str(out))
    assert {(r.split, r.label, r.name): r.length for r in listed.collect()} == {k: len(v) for k, v in expected.items()}
    assert {r[0] for r in rows.select(folders.file_name(F.col("id"), F.col("key"))).collect()} == {k[2] for k in expected}
    assert counts_agree(rows, listed).count() == 0
    os.remove(next(f"{d}/{f}" for d, _, names in os.walk(out) for f in names if not f.startswith("_")))
    assert [(r.expected, r.copied) for r in counts_agree(rows, folders.listing(spark, str(out)), ("split", "label")).collect()] in ([(5, 4)], [(15, 14)])
    with pytest.raises(Exception, match="exists"):
        folders.write(rows, str(out))
    folders.write(rows.where("label = 'label 1'"), str(out), overwrite=True)
    assert folders.listing(spark, str(out)).count() == 20 and sorted(os.listdir(tmp_path)) == ["out"]


@pytest.mark.parametrize("bad", ["payload", "label", "twice"])
def test_a_failed_task_leaves_no_file(spark, tmp_path, bad):
    rows = manifest(spark, 60)
    if bad == "payload":
        rows = rows.withColumn("payload", F.when(F.col("id") != "a/7/x.jpg", F.col("payload")))
    if bad == "label":
        rows = rows.withColumn("label", F.when(F.col("id") != "a/7/x.jpg", F.col("label")).otherwise("../up"))
    if bad == "twice":
        rows = rows.unionByName(rows.where("id = 'a/7/x.jpg'"))
    with pytest.raises(CountMismatch if bad == "twice" else Exception, match={"payload": "no payload", "label": "can't be a folder", "twice": "rows"}[bad]):
        folders.write(rows, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path)) == (["out"] if bad == "twice" else [])


def shades(rng, height, width):
    return rng.integers(0, 256, (height, width, 3), dtype=np.uint8)


def bmp(x):
    """A 24-bit BMP file."""
    height, width, _ = x.shape
    lines = b"".join(row[:, ::-1].tobytes() + b"\0" * (-3 * width % 4) for row in x[::-1])
    head = b"BM" + (54 + len(lines)).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little")
    return head + (40).to_bytes(4, "little") + width.to_bytes(4, "little") + height.to_bytes(4, "little") + b"\1\0\x18\0" + b"\0" * 24 + lines


def test_images(spark, tmp_path):
    rng = np.random.default_rng(4)
    colours = shades(rng, 9, 7)
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "sub dir" / "a.bmp").write_bytes(bmp(colours))
    (tmp_path / "grey.png").write_bytes(stores.png((rng.random(64) * 2 - 1).tolist(), 8))
    (tmp_path / "broken.png").write_bytes(b"\x89PNG\r\n\x1a\nnothing")
    (tmp_path / "note.txt").write_bytes(b"no image")
    found = images.read(spark, str(tmp_path))
    got = {r.path.split("/")[-1]: r for r in found.collect()}
    assert {k: (r.valid, r.height, r.width, r.channels) for k, r in got.items()} == {"a.bmp": (True, 9, 7, 3), "grey.png": (True, 8, 8, 1), "broken.png": (False, None, None, None)}
    assert np.array_equal(images.rgb(bytes(got["a.bmp"].data), 9, 7, 3), colours)
    sized = {r.path.split("/")[-1]: r.pixels for r in images.pixels(found, 8).collect()}
    assert sized["broken.png"] is None and len(sized["grey.png"]) == 8 * 8 * 3 and sized["grey.png"][0::3] == sized["grey.png"][2::3]
    assert np.array_equal(np.array(sized["a.bmp"]).reshape(8, 8, 3), images.resized(colours, 8))
    keys = {r[0] for r in found.select(images.below(F.col("path"), str(tmp_path))).collect()}
    assert keys == {"sub dir/a.bmp", "grey.png", "broken.png"}


def test_resizing():
    rng = np.random.default_rng(5)
    for given, wanted in ((10, 10), (10, 4), (4, 10), (224, 17), (3, 224), (1, 5)):
        w = images.weights(given, wanted)
        assert w.shape == (wanted, given) and np.allclose(w.sum(axis=1), 1)
    x = shades(rng, 12, 20)
    assert np.array_equal(images.resized(x[:, :12], 12), x[:, :12])  # nothing to do
    assert (images.resized(np.full((30, 50, 3), 77, np.uint8), 13) == 77).all()
    halves = np.zeros((64, 64, 3), np.uint8)
    halves[:, 32:] = 200
    small = images.resized(halves, 8)
    assert (small[:, :2] == 0).all() and (small[:, 6:] == 200).all() and small.dtype == np.float32


def test_embedder(spark, tmp_path):
    rng = np.random.default_rng(6)
    for i in range(40):
        (tmp_path / f"{i}.bmp").write_bytes(bmp(shades(rng, 5, 5)))

    def model():
        return lambda x: x.reshape(len(x), -1)[:, :6]

    rows = spark.createDataFrame([(str(i), f"{i}.bmp") for i in range(40)], "id string, key string")
    embed = images.embedder(str(tmp_path), model, size=5, width=6, at_once=7)
    got = embed(rows).collect()
    assert len(got) == 40 and all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 and r.embedding_backend == "efficientnet" for r in got)
    (tmp_path / "7.bmp").write_bytes(b"BM")
    with pytest.raises(Exception, match="no image that can be decoded for 7.bmp"):
        embed(rows).collect()
