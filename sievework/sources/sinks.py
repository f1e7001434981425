"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import basename
from . import keyed

_RATES = T.StructType([T.StructField("accuracy", T.DoubleType()), T.StructField("done_when_not_done_fp_rate", T.DoubleType())])
_SUMMARY = T.StructType([T.StructField("count", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in ("mean", "min", "max")])
BASELINES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("brand", "model", "created_at")]
    + [T.StructField("sample_count", T.LongType()), T.StructField("label_distribution", T.MapType(T.StringType(), T.LongType()))]
    + [T.StructField("confidence", _SUMMARY), T.StructField("quality_metrics", _RATES)]
)
REGISTRY = T.StructType([T.StructField(c, T.StringType()) for c in ("brand", "model_package_group", "model", "approval_status", "quality_gate", "created_at")])


def alphabetical_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def json_lines(df: DataFrame, path: str) -> None:
    """One object a line, keys in alphabetical order, nulls written."""
    df.select(alphabetical_json(df).alias("value")).write.mode("overwrite").text(path)


def metrics_then_check(metrics: DataFrame, path: str, gate) -> None:
    """Metrics are written before the gate can raise, so that a failure leaves evidence."""
    json_lines(metrics, path)
    gate.require(metrics)


def baseline(report: DataFrame, brand: str, model_id: str, created_at: str) -> DataFrame:
    """Baseline statistics of one model, keyed by brand and model id."""
    m = F.col("metrics")
    rates = F.struct(m["accuracy"].alias("accuracy"), m["done_when_not_done_fp_rate"].alias("done_when_not_done_fp_rate"))
    return report.select(
        F.lit(brand).alias("brand"), F.lit(model_id).alias("model"), F.lit(created_at).alias("created_at"), m["sample_count"].alias("sample_count"),
        m["label_distribution"].alias("label_distribution"), m["confidence_summary"].alias("confidence"), rates.alias("quality_metrics"),
    )


def registration(brand: str, group: str, model_id: str, report: DataFrame, created_at: str) -> DataFrame:
    """A row for the model registry; approval is always manual."""
    return report.select(
        F.lit(brand).alias("brand"), F.lit(group).alias("model_package_group"), F.lit(model_id).alias("model"), F.lit("PendingManualApproval").alias("approval_status"),
        "quality_gate", F.lit(created_at).alias("created_at"),
    )


def register(registry: DataFrame, baselines: DataFrame, out: str, commit: str) -> None:
    """Put a run's rows into ``out``/registry and its statistics into ``out``/baselines. Those of other brands, models and runs stay, and the same
    run once more changes nothing."""
    keyed.replace(baselines, f"{out}/baselines", ("brand", "model"))
    keyed.append_once(registry, f"{out}/registry", commit)


def registered(spark: SparkSession, out: str) -> DataFrame:
    """The registry's newest row of each brand and model, with the model's version: its place among the group's models by time."""
    rows = keyed.latest(keyed.read(spark, f"{out}/registry", REGISTRY), ("brand", "model"), "created_at")
    return rows.withColumn("version", F.row_number().over(Window.partitionBy("brand", "model_package_group").orderBy("created_at", "model")))


def baselines(spark: SparkSession, out: str) -> DataFrame:
    return keyed.read(spark, f"{out}/baselines", BASELINES).drop(keyed.COMMIT)


def approval_event(report: DataFrame, brand: str, group: str, model_id: str, model_uri: str, baseline_uri: str) -> DataFrame:
    """(detail): JSON with nine keys in alphabetical order."""
    m = F.col("metrics")
    parts = {
        "accuracy": m["accuracy"], "baseline_uri": F.lit(baseline_uri), "brand_id": F.lit(brand), "done_when_not_done_fp_rate": m["done_when_not_done_fp_rate"], "model_package": F.lit(model_id),
        "model_package_group": F.lit(group), "model_uri": F.lit(model_uri), "quality_gate": F.col("quality_gate"), "sample_count": m["sample_count"],
    }
    return report.select(F.to_json(F.struct(*(parts[k].alias(k) for k in sorted(parts))), {"ignoreNullFields": "false"}).alias("detail"))


def registration_result(registry: DataFrame, model_uri: str, baseline_uri: str, path: str) -> None:
    """What a registration gave, one JSON object: the registry's row with where model and baseline lie."""
    json_lines(registry.select("*", F.lit(model_uri).alias("model_uri"), F.lit(baseline_uri).alias("baseline_uri")), path)


def drift_signals(assessed: DataFrame, *more: str) -> DataFrame:
    """(endpoint, ts, level) and the columns ``more`` of rows to be written as signals."""
    return assessed.select("endpoint", "ts", F.col("level").cast("int").alias("level"), *more)


def file_stem(key: Column) -> Column:
    return F.regexp_replace(basename(key), r"(?s)^(.+)\.[^.]+$", "$1")
