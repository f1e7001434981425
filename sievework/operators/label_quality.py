"""Label issues: disagreement floor, confident joint, pruning by noise rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import argmax

DETECTOR = "confident-joint-1"


def predicted(classes: list[str], probs: str = "pred_probs") -> Column:
    return F.element_at(F.array(*map(F.lit, classes)), argmax(F.col(probs)) + 1)


def label_index(classes: list[str], label: str = "label") -> Column:
    """The class's index; an unknown label is an error."""
    at = F.array_position(F.array(*map(F.lit, classes)), F.col(label).cast("string"))
    return F.when(at > 0, at - 1).otherwise(F.raise_error(F.concat(F.lit("unknown label "), F.col(label).cast("string"))).cast("long")).cast("int")


def thresholds(rows: DataFrame) -> DataFrame:
    """(j, t): mean probability of class j over the rows labelled j."""
    return rows.select(F.col("y").alias("j"), F.element_at("pred_probs", F.col("y") + 1).alias("p")).groupBy("j").agg(F.avg("p").alias("t"))


def confident_joint(df: DataFrame, classes: list[str]) -> DataFrame:
    """(given, suggested, n): rows by their label and the likeliest class among those at or above its threshold."""
    rows = df.withColumn("y", label_index(classes))
    t = {r["j"]: r["t"] for r in thresholds(rows).collect()}  # one row a class
    bounds = F.array(*(F.lit(t.get(j)).cast("double") for j in range(len(classes))))
    above = F.transform(F.arrays_zip(F.col("pred_probs").alias("p"), bounds.alias("t")), lambda z: F.when(z["p"] >= z["t"], z["p"]).otherwise(F.lit(-1.0)))
    best = F.array_max(above)
    s = F.when(best >= 0, F.array_position(above, best) - 1)
    return rows.withColumn("s", s.cast("int")).where("s is not null").groupBy(F.col("y").alias("given"), F.col("s").alias("suggested")).agg(F.count(F.lit(1)).alias("n"))


def prune_by_noise_rate(df: DataFrame, classes: list[str], id_col: str = "id") -> DataFrame:
    """(id) of issues: for each pair of classes as many rows of the label as the calibrated joint says, of greatest margin between the
    other class and the label; margins count to nine places, ties go to the smaller id."""
    joint = confident_joint(df, classes)
    sizes = df.withColumn("y", label_index(classes)).groupBy("y").agg(F.count(F.lit(1)).alias("rows"))
    whole = joint.groupBy("given").agg(F.sum("n").alias("all"))
    quota = joint.where("given <> suggested").join(whole, "given").join(sizes, F.col("given") == F.col("y"))
    quota = quota.select("given", "suggested", F.round(F.col("n") * F.col("rows") / F.col("all")).cast("int").alias("k")).where("k > 0")
    rows = df.withColumn("y", label_index(classes)).select(F.col(id_col).alias("id"), "y", "pred_probs")
    margin = F.round(F.element_at("pred_probs", F.col("suggested") + 1) - F.element_at("pred_probs", F.col("y") + 1), 9)
    cells = rows.join(F.broadcast(quota), F.col("y") == F.col("given")).withColumn("margin", margin)  # classes squared rows at most
    order = Window.partitionBy("given", "suggested").orderBy(F.desc("margin"), "id")
    return cells.withColumn("r", F.row_number().over(order)).where("r <= k").select("id").distinct()


def flag(df: DataFrame, classes: list[str], floor: float = 0.5, detector: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """All rows with predicted_label, confidence, flagged and reason: near-duplicate before mislabel before ambiguous."""
    rows = df.withColumn("predicted_label", predicted(classes)).withColumn("confidence", F.array_max("pred_probs"))
    differs = F.col("predicted_label") != F.col("label").cast("string")
    near = F.coalesce(F.col("near_duplicate"), F.lit(False)) if "near_duplicate" in df.columns else F.lit(False)
    found = F.lit(False)
    if detector is not None:
        rows = rows.join(detector.select(F.col("id").alias(id_col), F.lit(True).alias("_found")), id_col, "left")
        found = F.coalesce(F.col("_found"), F.lit(False))
    flagged = found | (differs & (F.col("confidence") >= floor)) | near
    reason = F.when(near, "near-duplicate").when(differs, "mislabel").otherwise("ambiguous")
    return rows.withColumn("flagged", flagged).withColumn("reason", F.when(flagged, reason)).drop("_found")


def per_class(flagged: DataFrame) -> DataFrame:
    """(label, total, cleaned, flagged): classes that lose all rows are there with 0."""
    return flagged.groupBy("label").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("flagged")).alias("cleaned"), F.count_if("flagged").alias("flagged"))


def report(flagged: DataFrame, threshold: float) -> DataFrame:
    """One row of quality metrics; fractions and counts are 0 without rows."""
    by = per_class(flagged)
    sums = by.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_images"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_images"), F.coalesce(F.sum("cleaned"), F.lit(0)).alias("cleaned_count"),
        F.coalesce(F.min("cleaned"), F.lit(0)).alias("minimum_class_count"), F.count(F.lit(1)).alias("class_count"), F.count_if(F.col("cleaned") == 0).alias("classes_lost"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("label").cast("string"), "cleaned")))).alias("per_class_cleaned_counts"),
    )
    return sums.withColumn("flagged_fraction", F.coalesce(F.col("flagged_images") / F.nullif(F.col("total_images"), F.lit(0)), F.lit(0.0))).withColumn("flag_threshold_fraction", F.lit(threshold)).withColumn("detector", F.lit(DETECTOR))


def backend_metrics(df: DataFrame, real: str = "efficientnet") -> DataFrame:
    """One row: sorted embedding backends, rows that fell back, whether all rows are real."""
    backends = F.sort_array(F.collect_set("embedding_backend"))
    return df.agg(backends.alias("embedding_backends"), F.count_if(F.col("embedding_backend") != real).alias("deterministic_fallback_count"), (backends == F.array(F.lit(real))).alias("efficientnet_only"))
