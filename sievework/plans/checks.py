"""Queries of requests, claims, injected labels and gates over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Brand, Config, Selection
from ..operators import drift, events, gates, selection

LIMITS = Selection("o_*", 24, 40, 200, 233)
SWAPPED = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_request_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as uploads of a hundred brands, one request a brand: the fields of its event, and its keys in their order."""
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.concat("event_type", F.lit("-"), (F.col("user_id") % 20).cast("string")).alias("brand"), F.lit("raw").alias("bucket"), F.concat(F.lit("u/"), F.col("event_id").cast("string")).alias("key"))
    sent = events.training_events(events.coalesced(rows, "event_id"))
    field = lambda name: F.get_json_object("detail", f"$.{name}").alias(name)
    return sent.select("brand", F.array_join(F.json_object_keys("detail"), ",").alias("keys"), field("brand_id"), field("bucket"), field("key"), field("trigger"), F.get_json_object("detail", "$.coalesced_count").cast("long").alias("coalesced_count"))


def request_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a request's body and two claims: the fields that aren't allowed, and the brands that the claims name together."""
    e = table(spark, sf_dir, "events")
    body = F.to_json(F.create_map(F.lit("k"), F.lit("1"), F.col("event_type"), F.col("value").cast("string")))
    listed = F.concat(F.lit('["'), F.col("event_type"), F.lit('","shop"]'))
    spaced = F.concat(F.lit(" b"), (F.col("user_id") % 7).cast("string"), F.lit(" ; "), F.col("event_type"), F.lit(",,"))
    brands = events.allowed_brands(F.when(F.col("event_id") % 3 != 0, listed), spaced)
    return e.select("event_id", F.array_join(events.unexpected_fields(body, ["k", "view", "click"]), ",").alias("unexpected"), F.array_join(F.array_sort(brands), ",").alias("brands"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .registry import NOW, inventory

    return selection.candidates(inventory(spark, sf_dir), LIMITS.naming_pattern, NOW, LIMITS.recency_months)


def injected_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of which the first ones of two classes have each other's label."""
    rows = selection.swap_labels(_candidates(spark, sf_dir).select("id", "key", "label"), SWAPPED)
    return rows.groupBy("label", "injected").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))


def gates_on_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate of the dataset's bounds says of the candidates that are eligible, and the drift gate of every tenant."""
    from .registry import _tenants

    sizes = selection.selection_metrics(selection.eligible(_candidates(spark, sf_dir), LIMITS.min_per_class))
    bounds = gates.dataset_bounds(LIMITS).evaluate(sizes).select(F.lit("dataset").alias("subject"), "violations", "passed")
    levels = drift.step_status(_tenants(spark, sf_dir))
    drifts = gates.drift(Config((Brand("b", "b_*"),))).evaluate(levels).select(F.concat(F.lit("tenant "), F.col("tenant").cast("string")).alias("subject"), "violations", "passed")
    return bounds.unionByName(drifts).select("subject", F.array_join("violations", "; ").alias("violations"), "passed")


QUERIES = (training_request_events, request_claims, injected_labels, gates_on_metrics)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql(candidates: str, tenants: str) -> dict[str, str]:
    """``candidates`` and ``tenants``: the common tables ``cand``, ``elig`` and ``mult``."""
    return {
        "training_request_events": """WITH u AS (SELECT event_id, event_type || '-' || user_id % 20 AS brand FROM events),
g AS (SELECT brand, min(event_id) AS e, CASE WHEN count(*) > 1 THEN count(*) END AS coalesced_count FROM u GROUP BY brand)
SELECT brand, 'bucket,brand_id,' || CASE WHEN coalesced_count IS NULL THEN '' ELSE 'coalesced_count,' END || 'key,trigger' AS keys, brand AS brand_id, 'raw' AS bucket, 'u/' || e AS key, 'upload' AS trigger, coalesced_count FROM g""",
        "request_claims": """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN '' ELSE event_type END AS unexpected,
  array_to_string(list_sort(list_distinct(list_concat(CASE WHEN event_id % 3 <> 0 THEN [event_type, 'shop'] ELSE [] END, ['b' || user_id % 7, event_type]))), ',') AS brands FROM events""",
        "injected_labels": f"""WITH {candidates}, two AS (SELECT DISTINCT label FROM cand ORDER BY label LIMIT 2),
hit AS (SELECT id FROM cand WHERE label IN (SELECT label FROM two) ORDER BY label, key, id LIMIT {SWAPPED}),
s AS (SELECT key, id IN (SELECT id FROM hit) AS injected, CASE WHEN id IN (SELECT id FROM hit) THEN CASE WHEN label = (SELECT min(label) FROM two) THEN (SELECT max(label) FROM two) ELSE (SELECT min(label) FROM two) END ELSE label END AS label FROM cand)
SELECT label, injected, count(*) AS n, min(key) AS first_key FROM s GROUP BY label, injected""",
        "gates_on_metrics": f"""WITH {candidates}, {tenants}, c AS (SELECT count(*) AS n FROM elig GROUP BY label), m AS (SELECT coalesce(sum(n), 0) AS size, coalesce(min(n), 0) AS least FROM c),
b AS (SELECT 'dataset' AS subject, concat_ws('; ', CASE WHEN size < {LIMITS.target_min} THEN 'dataset_size >= {LIMITS.target_min}' END, CASE WHEN size > {LIMITS.target_max} THEN 'dataset_size <= {LIMITS.target_max}' END, CASE WHEN least < {LIMITS.min_per_class} THEN 'minimum_class_count >= {LIMITS.min_per_class}' END) AS violations FROM m
UNION ALL SELECT 'tenant ' || tenant, concat_ws('; ', CASE WHEN confidence < 0.65 THEN 'confidence >= 0.65' END, CASE WHEN mult > 3 THEN 'correction_rate_multiplier <= 3.0' END) FROM mult)
SELECT subject, violations, violations = '' AS passed FROM b""",
    }
