"""Queries that write to a table or to files, read back, and say what is there."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Drift
from ..operators import brands
from ..sources import folders, images, keyed, npy, readers
from ..storage import shared_dir
from ..streaming import monitor, uploads


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


#: The day before which events count for a brand's baseline.
RELEASED = "2024-01-21"
#: The runs in order; the second one is repeated.
RUNS = (0, 1, 1, 2, 3)


def model_registry_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in four runs, each of which registers models of several brands and replaces their baselines; one run comes twice.

    Of each brand and model: registered rows and their samples, the newest registration, and the baseline. Models of odd users are in
    one run only, so their baselines have to outlast the later ones."""
    e = table(spark, sf_dir, "events")
    run = F.when(F.col("user_id") % 2 == 0, F.col("event_id") % 4).otherwise(F.floor(F.col("user_id") / 2) % 4).cast("int")
    rows = e.select(run.alias("run"), F.col("event_type").alias("brand"), F.format_string("%03d", F.col("user_id") % 24).alias("model"), "value")
    facts = rows.groupBy("run", "brand", "model").agg(F.count(F.lit(1)).alias("samples"), F.round(F.avg("value"), 6).alias("mean"))
    kind = T.StructType([T.StructField("brand", T.StringType()), T.StructField("model", T.StringType()), T.StructField("run", T.IntegerType()), T.StructField("samples", T.LongType()), T.StructField("mean", T.DoubleType())])
    out = new_folder(spark, "registry")
    for run_id in RUNS:
        own = facts.where(F.col("run") == run_id).select(kind.names)
        keyed.append_once(own, f"{out}/registry", f"run-{run_id}")
        keyed.replace(own, f"{out}/baselines", ("brand", "model"))
    registry = keyed.read(spark, f"{out}/registry", kind)
    newest = keyed.latest(registry, ("brand", "model"), "run").select("brand", "model", F.col("run").alias("newest_run"), F.col("samples").alias("newest_samples"))
    baselines = keyed.read(spark, f"{out}/baselines", kind).select("brand", "model", F.col("run").alias("baseline_run"), F.col("mean").alias("baseline_mean"))
    counted = registry.groupBy("brand", "model").agg(F.count(F.lit(1)).alias("registrations"), F.sum("samples").alias("samples"))
    return counted.join(newest, ["brand", "model"]).join(baselines, ["brand", "model"])


def npy_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in the order of vec_id, written as .npy files and read back: of each position, the sum of its vector's numbers and of its
    first eight. Partitions are a few rows wide, so that every file is read in several."""
    out = new_folder(spark, "matrix")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    npy.register(spark)
    rows.repartitionByRange("vec_id").sortWithinPartitions("vec_id").select("vector").write.format("npy").mode("append").save(out)
    total = lambda v: F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double")), 5)
    return npy.read(spark, out, 1 << 14).select("position", total(F.col("vector")).alias("total"), total(F.slice("vector", 1, 8)).alias("head"))


def png(values: list[float], side: int) -> bytes:
    """A grey image of side x side pixels, -1 to 1 from black to white."""
    grey = [min(255, max(0, int((v + 1) * 127.5 // 1))) for v in values[: side * side]]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = b"".join(b"\0" + bytes(grey[y * side : (y + 1) * side]) for y in range(side))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", side, side, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def class_folder_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a grey image of 8 x 8, written into class folders and decoded again: of each split and label the rows, the files, the
    images that decode, and the sum of their red, green and blue levels. Every 97th payload is cut short and counts as a file that can't
    be decoded."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawings = [png(v, 8) for v in batch.column("embedding").to_pylist()]
            cut = [d[:40] if i % 97 == 0 else d for i, d in zip(batch.column("vec_id").to_pylist(), drawings)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(cut, pa.binary())], names=["vec_id", "label", "payload"])

    out = new_folder(spark, "classes")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding").mapInArrow(drawn, "vec_id long, label int, payload binary")
    split = F.when(F.col("vec_id") % 5 == 0, "validation").otherwise("train")
    rows = rows.select(split.alias("split"), F.concat(F.lit("class-"), F.col("label").cast("string")).alias("label"), F.col("vec_id").cast("string").alias("id"), F.concat(F.lit("in/"), "vec_id", F.lit(".png")).alias("key"), "payload")
    folders.write(rows, out)
    of = lambda path, i: F.element_at(F.split(path, "/"), i)
    levels = F.aggregate("pixels", F.lit(0.0), lambda a, x: a + x.cast("double"))
    decoded = images.pixels(images.read(spark, out), 8).select(of("path", -3).alias("split"), of("path", -2).alias("label"), "valid", levels.alias("levels"))
    seen = decoded.groupBy("split", "label").agg(F.count(F.lit(1)).alias("files"), F.count_if("valid").alias("decoded"), F.coalesce(F.sum("levels"), F.lit(0.0)).cast("long").alias("levels"))
    return rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows")).join(seen, ["split", "label"], "left")


def imports_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings exported as two files that only their order connects, lines with the label and a matrix, and put side by side again."""
    out = new_folder(spark, "imports")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("value"), F.col("embedding").alias("vector"))
    ordered = rows.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    npy.register(spark)
    ordered.select(F.coalesce("value", F.lit("")).alias("value")).write.text(f"{out}/labels")
    ordered.select("vector").write.format("npy").mode("append").save(f"{out}/matrix")
    labels = readers.numbered_lines(spark, f"{out}/labels").select("position", F.col("value").alias("label"))
    both = readers.by_position(labels, npy.read(spark, f"{out}/matrix", 1 << 14).select("position", "vector"))
    return both.select("position", "label", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"))


def brand_table_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as file names against a table of patterns: one for each customer in credit, then two that any name may end with."""
    number = F.format_string("c%08d", F.col("o_custkey"))
    names = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(number, F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("name"))
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    own = c.select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("brand"), F.concat(F.format_string("c%08d", F.col("c_custkey")), F.lit("_*")).alias("pattern"))
    rest = spark.createDataFrame([(1 << 40, "low", "*[0-4].jpg"), (1 << 41, "rest", "*.jpg")], "ordinal long, brand string, pattern string")
    return brands.with_first_match(names, "name", own.unionByName(rest)).select("o_orderkey", "brand")


def drift_monitor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through the monitor as a stream that ends when it has read them: endpoints are users' last digits, brands their halves, and a
    brand's baseline is its share of errors before the given day. The signals' levels, and the alarms of the windows that they lie in."""
    e = table(spark, sf_dir, "events")
    endpoint, brand = F.concat(F.lit("e"), (F.col("user_id") % 10).cast("string")), F.concat(F.lit("b"), F.floor((F.col("user_id") % 10) / 5).cast("string"))
    error = F.col("event_type") == "error"
    old = e.where(F.col("ts") < F.lit(RELEASED).cast("timestamp_ntz")).groupBy(brand.alias("brand")).agg(F.avg(error.cast("double")).alias("rate"))
    released = old.withColumn("model", F.lit("m1")).withColumn("created_at", F.lit(RELEASED))
    out = new_folder(spark, "monitor")
    # a stream's path is a folder or a pattern; the table may be a file or a folder
    stream = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/event[s].parquet")
    rows = stream.select(endpoint.alias("endpoint"), brand.alias("brand_id"), F.col("ts").cast("timestamp").alias("ts"), F.least(F.col("value") / 60, F.lit(1.0)).alias("confidence"), error.alias("corrected"))
    query = monitor.monitor(rows, lambda: monitor.newest_rates(released), f"{out}/signals", f"{out}/checkpoint", f"monitor-{uuid.uuid4().hex}", Drift(0.30, 0.35, multiplier=1.05), every=None)
    uploads.wait(query, 3_600)
    found = monitor.signals(spark, f"{out}/signals")
    found = found.withColumn("window_start", F.floor(F.unix_timestamp("ts") / 300) * 300)
    alarmed = monitor.alarms(spark, f"{out}/signals").select("endpoint", F.unix_timestamp("window_start").alias("window_start"), "level2", "level3")
    told = found.select("endpoint", "window_start", "predictions", F.round("confidence", 6).alias("confidence"), F.round("correction_rate", 6).alias("correction_rate"), F.round("rate", 6).alias("rate"), "level")
    return told.join(alarmed, ["endpoint", "window_start"])


QUERIES = (model_registry_runs, npy_round_trip, class_folder_images, imports_by_position, brand_table_match, drift_monitor_stream)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "model_registry_runs": """WITH rows AS (SELECT CASE WHEN user_id % 2 = 0 THEN event_id % 4 ELSE (user_id // 2) % 4 END AS run, event_type AS brand, lpad(CAST(user_id % 24 AS VARCHAR), 3, '0') AS model, value FROM events),
facts AS (SELECT run, brand, model, count(*) AS samples, round(avg(value), 6) AS mean FROM rows GROUP BY ALL)
SELECT brand, model, count(*) AS registrations, CAST(sum(samples) AS BIGINT) AS samples, CAST(max(run) AS INT) AS newest_run, arg_max(samples, run) AS newest_samples, CAST(max(run) AS INT) AS baseline_run, arg_max(mean, run) AS baseline_mean
FROM facts GROUP BY brand, model""",
        "npy_round_trip": """SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 5) AS total,
  round(list_sum(list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE))), 5) AS head FROM embeddings""",
        "class_folder_images": """WITH p AS (SELECT CASE WHEN vec_id % 5 = 0 THEN 'validation' ELSE 'train' END AS split, 'class-' || label AS label, vec_id % 97 <> 0 AS whole,
  list_sum(list_transform(embedding[1:64], lambda x: least(255, greatest(0, floor((CAST(x AS DOUBLE) + 1) * 127.5))))) AS grey FROM embeddings)
SELECT split, label, count(*) AS rows, count(*) AS files, count(*) FILTER (whole) AS decoded, CAST(coalesce(sum(3 * grey) FILTER (whole), 0) AS BIGINT) AS levels FROM p GROUP BY split, label""",
        "drift_monitor_stream": f"""WITH p AS (SELECT 'e' || user_id % 10 AS endpoint, 'b' || (user_id % 10) // 5 AS brand, ts, least(value / 60, 1.0) AS confidence, CAST(event_type = 'error' AS INT) AS corrected FROM events),
rates AS (SELECT brand, avg(corrected) AS rate FROM p WHERE ts < TIMESTAMP '{RELEASED}' GROUP BY brand),
s AS (SELECT endpoint, brand, CAST(floor(epoch(max(ts)) / 300) AS BIGINT) * 300 AS window_start, count(*) AS predictions, avg(confidence) AS confidence, avg(corrected) AS correction_rate FROM p GROUP BY endpoint, brand),
l AS (SELECT *, CASE WHEN CASE WHEN rate = 0 THEN correction_rate > 0 ELSE correction_rate >= rate * 1.05 END THEN 3 WHEN confidence < 0.30 THEN 2 WHEN confidence < 0.35 THEN 1 ELSE 0 END AS level FROM s JOIN rates USING (brand))
SELECT endpoint, window_start, predictions, round(confidence, 6) AS confidence, round(correction_rate, 6) AS correction_rate, round(rate, 6) AS rate, CAST(level AS INT) AS level, level >= 2 AS level2, level >= 3 AS level3 FROM l""",
        "imports_by_position": """SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, coalesce(CAST(label AS VARCHAR), '') AS label, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 5) AS total FROM embeddings""",
        "brand_table_match": """SELECT o_orderkey, CASE WHEN c_acctbal > 0 THEN 'n' || c_nationkey WHEN o_orderkey % 10 <= 4 THEN 'low' ELSE 'rest' END AS brand FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    }
