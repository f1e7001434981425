"""Readers with declared schemas. Paths can be in any store that Spark reads."""

from __future__ import annotations

import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Suffixes of image files.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".gif", ".webp")
INVENTORY = T.StructType([T.StructField("id", T.StringType()), T.StructField("key", T.StringType()), T.StructField("last_modified", T.TimestampType())])
MAPPING = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "key", "image_path", "label", "source_brand")] + [T.StructField("source_confidence", T.DoubleType()), T.StructField("is_duplicate", T.BooleanType()), T.StructField("embedding_backend", T.StringType())])
RATES = "observed_correction_rate string, baseline_correction_rate string"


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of objects; malformed input fails."""
    return spark.read.schema(INVENTORY).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_records(spark: SparkSession, path: str, schema: T.StructType = MAPPING) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def image_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, key, last_modified, length) of image files at any depth, in order of the path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return files.where(suffix.isin(*IMAGE_SUFFIXES)).orderBy("path").select("path", F.element_at(F.split("path", "/"), -1).alias("key"), F.col("modificationTime").alias("last_modified"), "length")


def flat_listing(spark: SparkSession, root: str, now: Column) -> DataFrame:
    """(id, key, last_modified = now) of the *.jpg files of one folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("id"), name.alias("key"), now.alias("last_modified"))


def labelled_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, label): the label is the parent folder."""
    return image_listing(spark, root).select("path", F.element_at(F.split("path", "/"), -2).alias("label"))


def same_classes(a: DataFrame, b: DataFrame) -> bool:
    rows = lambda d: d.agg(F.sort_array(F.collect_set("label"))).first()[0]
    return rows(a) == rows(b)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with label, prediction and an optional confidence. Blank lines are skipped; a line without a required key is an error
    that names the file, the line's number and its text; no line at all is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    if not lines.take(1):
        raise ValueError(f"no predictions in {path}")
    row = F.from_json("value", "label string, prediction string, confidence double", {"mode": "PERMISSIVE"})
    parsed = lines.withColumn("r", row)
    ok = F.col("r.label").isNotNull() & F.col("r.prediction").isNotNull()
    bad = ~F.coalesce(ok, F.lit(False))
    if parsed.where(bad).take(1):
        numbered = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("r", row).where(bad)
        wrong = numbered.agg(F.min(F.struct("position", "file", "line", "value")).alias("first")).first()["first"]
        raise ValueError(f"a prediction needs label and prediction: {wrong['file']}, line {wrong['line']}: {wrong['value']}")
    return parsed.select("r.label", "r.prediction", "r.confidence")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, position, value) of the lines of text files, however Spark splits them: the line's number in its file from 1, and from 0 its
    place among all lines, files in the order of their names.

    A split's lines are numbered as they are read; where a split begins follows from the numbers of lines in those before it. Only these
    numbers, one row a split, are put in order. Files must not change meanwhile."""
    m = F.col("_metadata")
    lines = spark.read.text(path).select("value", m["file_path"].alias("file"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("_i"))
    splits = lines.groupBy("file", "block").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))  # one row a split
    within = F.sum("_n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.coalesce(within, F.lit(0)).alias("_within"))
    both = lines.join(splits, ["file", "block"])
    at = F.col("_i") - F.col("_first")
    return both.select("file", (F.col("_within") + at + 1).alias("line"), (F.col("_before") + at).alias("position"), "value")


def by_position(labels: DataFrame, rows: DataFrame) -> DataFrame:
    """Two imports with a ``position`` each, side by side; a position that only one of them has is an error that names it."""
    both = labels.withColumn("_l", F.lit(True)).join(rows.withColumn("_r", F.lit(True)), "position", "full")
    lone = F.col("_l").isNull() | F.col("_r").isNull()
    said = F.raise_error(F.concat(F.lit("only one of two imports has position "), F.col("position").cast("string"))).cast("long")
    return both.withColumn("position", F.when(lone, said).otherwise(F.col("position"))).drop("_l", "_r")


def matrix(spark: SparkSession, path: str) -> DataFrame:
    """(position, vector) of .npy matrices; each file is one task's work."""
    import numpy as np
    import pandas as pd

    def read(frames):
        for frame in frames:
            for content in frame["content"]:
                m = np.load(io.BytesIO(content), allow_pickle=False)
                yield pd.DataFrame({"position": np.arange(len(m)), "vector": list(m.astype(np.float32))})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "position long, vector array<float>")


def file_digests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.sha2("content", 256).alias("sha256"))


def correction_rate(spark: SparkSession, path: str) -> DataFrame:
    """(observed, baseline, reason): the two rates as doubles, or the reason why there is no multiplier."""
    r = spark.read.schema(RATES).option("multiLine", True).json(path)
    o, b = F.col("observed_correction_rate").try_cast("double"), F.col("baseline_correction_rate").try_cast("double")
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    reason = (
        F.when(F.col("observed_correction_rate").isNull() | F.col("baseline_correction_rate").isNull(), "field_missing")
        .when(o.isNull() | b.isNull(), "not_a_number")
        .when(bad(o) | bad(b), "not_finite")
        .when((o < 0) | (b < 0), "negative")
        .when(b == 0, "baseline_zero")
    )
    return r.select(o.alias("observed"), b.alias("baseline"), reason.alias("reason"))


def latest_checkpoint(listing: DataFrame) -> DataFrame:
    """One row (path, epoch) of the greatest epoch among files named epoch-<n>.weights.h5, or files in folders named
    epoch-<n>.weights.parquet; null without any."""
    epoch = F.regexp_extract("path", r"epoch-([0-9]+)\.weights\.(?:h5$|parquet/[^/]+$)", 1).try_cast("int")
    return listing.withColumn("epoch", epoch).where("epoch is not null").agg(F.max_by("path", "epoch").alias("path"), F.max("epoch").alias("epoch"))


def resolved(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows whose image_path, else key, else id is a listed file."""
    path = F.coalesce(*(F.col(c) for c in ("image_path", "key", "id") if c in manifest.columns))
    return manifest.withColumn("_p", path).join(listing.select(F.col("path").alias("_p")).distinct(), "_p", "left_semi").drop("_p")
