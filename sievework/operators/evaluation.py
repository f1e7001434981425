"""Evaluation metrics, quality gate, aborts and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Evaluation


def metrics(predictions: DataFrame, settings: Evaluation = Evaluation()) -> DataFrame:
    """One row from (label, prediction, confidence): counts, accuracy, hazardous false-positive rate (null without hazardous rows),
    label distribution, confidence summary. Two nulls are equal, as labels; without rows the rates are null."""
    hazard, safe = F.lit(settings.hazard_label), F.lit(settings.safe_label)
    is_hazard = F.coalesce(F.col("label") == hazard, F.lit(False))
    missed = is_hazard & F.coalesce(F.col("prediction") == safe, F.lit(False))
    by = predictions.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label").eqNullSafe(F.col("prediction"))).alias("right"), F.count_if(is_hazard).alias("hazard"), F.count_if(missed).alias("missed"), F.count_if(F.col("label") == safe).alias("safe"),
        F.count("confidence").alias("c"), F.sum("confidence").alias("cs"), F.min("confidence").alias("c0"), F.max("confidence").alias("c1"),
    )
    total = by.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("sample_count"), F.sum("right").alias("right"), F.coalesce(F.sum("hazard"), F.lit(0)).alias("not_done_sample_count"), F.coalesce(F.sum("missed"), F.lit(0)).alias("false_positives"),
        F.coalesce(F.sum("safe"), F.lit(0)).alias("done_sample_count"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(F.col("label").cast("string"), F.lit("None")), "n")))).alias("label_distribution"),
        F.struct(F.sum("c").alias("count"), (F.sum("cs") / F.nullif(F.sum("c"), F.lit(0))).alias("mean"), F.min("c0").alias("min"), F.max("c1").alias("max")).alias("confidence_summary"),
    )
    rate = F.col("false_positives") / F.nullif(F.col("not_done_sample_count"), F.lit(0))
    return total.select("sample_count", (F.col("right") / F.nullif(F.col("sample_count"), F.lit(0))).alias("accuracy"), rate.alias("done_when_not_done_fp_rate"), rate.alias("emergency_false_positive_rate"), "false_positives", "not_done_sample_count", "done_sample_count", "label_distribution", "confidence_summary")


def quality_gate(settings: Evaluation = Evaluation()) -> Column:
    """'passed' or 'failed'; a null rate fails."""
    ok = (F.col("accuracy") >= settings.accuracy) & ~F.isnan("accuracy") & (F.col("done_when_not_done_fp_rate") <= settings.false_positive_rate)
    return F.when(ok, "passed").otherwise("failed")


def with_run_facts(rows: DataFrame, missing_images: DataFrame, latencies: DataFrame) -> DataFrame:
    """Add missing_images (rows of a table of missing files) and latency_ms (mean of column ms, 0 without rows)."""
    missing = missing_images.agg(F.count(F.lit(1)).alias("missing_images"))
    return rows.crossJoin(missing).crossJoin(latencies.agg(F.coalesce(F.avg("ms"), F.lit(0.0)).alias("latency_ms")))  # one row each


def with_aborts(rows: DataFrame, settings: Evaluation = Evaluation()) -> DataFrame:
    """abort_reason where a floor is missed, and then sentinels: accuracy 0, false-positive rate 1."""
    reasons = F.array_compact(F.array(
        F.when(F.col("not_done_sample_count") == 0, F.lit("no rows of the hazardous label")),
        F.when(F.col("missing_images") > 0, F.lit("missing images")),
        F.when(F.col("sample_count") < settings.least_samples, F.lit("too few samples")),
        F.when((F.col("not_done_sample_count") < settings.least_per_class) | (F.col("done_sample_count") < settings.least_per_class), F.lit("too few samples of a label")),
    ))
    out = rows.withColumn("abort_reason", F.when(F.size(reasons) > 0, F.array_join(reasons, "; ")))
    bad = F.col("abort_reason").isNotNull()
    return out.withColumn("accuracy", F.when(bad, 0.0).otherwise(F.col("accuracy"))).withColumn("emergency_false_positive_rate", F.when(bad, 1.0).otherwise(F.col("emergency_false_positive_rate")))


def report(rows: DataFrame, settings: Evaluation = Evaluation()) -> DataFrame:
    """The nested report as one row."""
    rate = F.col("done_when_not_done_fp_rate")
    measure = lambda c: F.struct(c.alias("value"), F.lit(None).cast("double").alias("standard_deviation"))
    return rows.select(
        F.lit("1.0").alias("schema_version"), quality_gate(settings).alias("quality_gate"),
        F.struct(F.lit(settings.accuracy).alias("accuracy"), F.lit(settings.false_positive_rate).alias("done_when_not_done_fp_rate")).alias("thresholds"),
        F.struct("sample_count", "accuracy", rate, "false_positives", "not_done_sample_count", "label_distribution", "confidence_summary").alias("metrics"),
        F.struct(F.struct(measure(F.col("accuracy")).alias("accuracy"), measure(rate).alias("done_when_not_done_fp_rate")).alias("classification_metrics")).alias("model_metrics"),
    )


def recall_of_injected(flagged: DataFrame) -> DataFrame:
    return flagged.where("injected").agg(F.avg(F.col("flagged").cast("double")).alias("recall"))


def missing_files(manifest: DataFrame, listing: DataFrame, key: str = "image_path") -> DataFrame:
    return manifest.join(listing.select(key).distinct(), key, "left_anti")
