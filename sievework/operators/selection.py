"""Curated selection: tenant, recency, class size, stratified cap."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Selection
from ..functions import names


class SelectionError(ValueError):
    pass


def candidates(inventory: DataFrame, pattern: str, now: datetime, recency_months: int) -> DataFrame:
    """Rows of one tenant that are recent enough, with parsed names; a month counts 30 days, the cutoff itself is recent enough.

    Input: key, last_modified and optionally id (else the key). The glob and the cutoff reach the scan before any name is parsed."""
    key_only = "id" not in inventory.columns
    cutoff = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {recency_months * 30} DAYS")
    rows = inventory.where(names.matches_glob(names.basename(F.col("key")), pattern) & (F.col("last_modified").cast("timestamp") >= cutoff))
    return rows.withColumn("_p", names.strict_parts(F.col("key"))).select(
        (F.col("key") if key_only else F.coalesce(F.col("id").cast("string"), F.col("key"))).alias("id"), "key", F.col("_p.label").alias("label"), F.col("_p.brand").alias("source_brand"),
        F.col("_p.confidence").alias("source_confidence"), F.col("last_modified").cast("timestamp").alias("last_modified"),
    )


def eligible(rows: DataFrame, min_per_class: int) -> DataFrame:
    """Rows of classes with enough members; only counts are shuffled for the decision."""
    big = rows.groupBy("label").count().where(F.col("count") >= min_per_class).select("label")
    return rows.join(big, "label", "left_semi")


def stratified_cap(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, dealt to the classes in turn: the r-th row of every class comes before any (r+1)-th, classes in order.

    That is a quota for each class with the rest going round. Ranks above ``most`` go before the shuffle; ties in key go by id."""
    order = Window.partitionBy("label").orderBy("key", "id")
    return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).orderBy("_r", "label").limit(most).drop("_r")


def class_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def selection_metrics(rows: DataFrame) -> DataFrame:
    """One row: dataset_size, minimum_class_count (0 without rows), class_distribution as a map in label order."""
    by = class_sizes(rows)
    return by.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("dataset_size"), F.coalesce(F.min("n"), F.lit(0)).alias("minimum_class_count"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n")))).alias("class_distribution"),
    )


def select_curated(inventory: DataFrame, settings: Selection, now: datetime) -> DataFrame:
    """The curated manifest, ordered by label, key and id. Fails with too few rows, with a cap that can't hold the minimum of every
    class, and on a name that can't be parsed."""
    rows = eligible(candidates(inventory, settings.naming_pattern, now, settings.recency_months), settings.min_per_class)
    found = class_sizes(rows).agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if found["rows"] < settings.target_min:
        raise SelectionError(f"{found['rows']} rows are below required minimum {settings.target_min}")
    if found["rows"] > settings.target_max:
        if settings.target_max // found["classes"] < settings.min_per_class:
            raise SelectionError(f"a cap of {settings.target_max} can't hold {settings.min_per_class} rows of each of {found['classes']} classes")
        rows = stratified_cap(rows, settings.target_max)
    return rows.orderBy("label", "key", "id")


def select_lenient(listing: DataFrame, pattern: str) -> DataFrame:
    """The form without recency and cap: names that don't split are skipped, the brand must be the pattern's literal one."""
    rows = listing.where(names.matches_glob(names.basename(F.col("key")), pattern)).withColumn("_p", names.lenient_parts(F.col("key")))
    return rows.where(F.col("_p.brand") == names.brand_token(pattern)).select(F.col("key").alias("id"), "key", F.col("key").alias("image_path"), F.col("_p.label").alias("label"), F.col("_p.confidence").alias("confidence"))


def swap_labels(rows: DataFrame, n: int) -> DataFrame:
    """Demo helper: the first n rows of the first two classes get each other's label; ``injected`` marks them."""
    two = [r["label"] for r in rows.select("label").distinct().orderBy("label").limit(2).collect()]
    if len(two) < 2:
        return rows.withColumn("injected", F.lit(False))
    chosen = rows.where(F.col("label").isin(two)).orderBy("label", "key", "id").limit(n).select("id", F.lit(True).alias("_hit"))
    swapped = F.when(F.col("label") == two[0], F.lit(two[1])).otherwise(F.lit(two[0]))
    return rows.join(chosen, "id", "left").withColumn("label", F.when(F.col("_hit"), swapped).otherwise(F.col("label"))).withColumn("injected", F.coalesce("_hit", F.lit(False))).drop("_hit")
