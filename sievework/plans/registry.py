"""Queries of the operators over the driver's tables, and the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Drift, Evaluation, Selection
from ..functions import names
from ..functions.vectors import argmax, hash_words
from ..functions.vectors import hash_embedding as embedding_of
from ..operators import boosting, dedup, drift, evaluation, events, folds, gates, label_quality, reconcile, selection
from . import checks, stores

NOW = datetime(2000, 1, 1)
SETTINGS = Selection("o_*", 24, 40, 200, 233)
CLASSES = [str(i) for i in range(10)]
PATTERNS = [("shop", "*.example.com"), ("blog", "blog.*"), ("spam", "spam-*"), ("org", "*.example.or[!a-f]")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    nn = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    return o.select(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lower("o_orderstatus"), F.lit("_"), "o_orderpriority", F.lit("_0."), nn, F.lit(".jpg")).alias("key"), F.col("o_orderdate").cast("timestamp").alias("last_modified"))


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    a = F.transform(F.slice("embedding", 1, 10), lambda x: F.abs(x.cast("double")))
    total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), F.transform(a, lambda x: x / total).alias("pred_probs"))


def select_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.select_curated(inventory(spark, sf_dir), SETTINGS, NOW)
    return rows.select("id", "key", "label", "source_brand", "source_confidence", F.date_format("last_modified", "yyyy-MM-dd").alias("modified_on"))


def selection_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.eligible(selection.candidates(inventory(spark, sf_dir), "o_*", NOW, 24), 40)
    m = selection.selection_metrics(rows)
    return m.select("dataset_size", "minimum_class_count", F.explode("class_distribution").alias("label", "n"))


def select_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.select_lenient(inventory(spark, sf_dir), "f_*").groupBy("label", "confidence").agg(F.count(F.lit(1)).alias("n"))


def brand_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.split(F.regexp_replace("url", "^https?://", ""), "[/?#]")[0]
    rows = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), names.decoded_key(F.col("url")).alias("decoded"))
    brand = names.first_match(F.col("host"), PATTERNS)
    return rows.select("page_id", brand.alias("brand"), F.length("decoded").cast("long").alias("n_decoded")).where("brand is not null")


def upload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("event_type").alias("brand"), F.lit("raw").alias("bucket"), F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string")).alias("key"), events.window_number(F.col("ts")).alias("window_number"))


def upload_coalesce_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events.coalesced(upload_events(spark, sf_dir), "event_id", ("brand", "window_number"))
    return rows.withColumn("display_name", events.display_name(F.lit("curation"), F.col("brand"), F.col("window_number")))


def upload_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both event shapes, built from events, parsed back."""
    e = table(spark, sf_dir, "events")
    obj = F.concat(F.lit('{"bucket":{"name":"raw"},"object":{"key":"in%20box/'), F.col("event_type"), F.lit("+"), F.col("event_id").cast("string"), F.lit('.jpg"}}'))
    body = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"Records":[{"s3":'), obj, F.lit('},{"s3":{"bucket":{"name":"raw"},"object":{}}}]}'))).otherwise(F.concat(F.lit('{"detail":'), obj, F.lit("}")))
    rows = events.uploads(e.select("event_id", body.alias("value")))
    return rows.select("event_id", "bucket", "key")


def in_flight_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("brand", F.concat(F.lit("b"), (F.col("user_id") % 50).cast("string")))
    last = e.groupBy("brand").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("t"))
    executions = last.select("brand", F.when(F.col("t") == "view", "Executing").when(F.col("t") == "click", "Stopping").otherwise("Succeeded").alias("status"))
    requests = e.where("event_type = 'purchase'").groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    return events.suppressed(requests, executions)


def training_request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = upload_events(spark, sf_dir).withColumn("brand", F.concat(F.col("brand"), F.lit("-"), (F.col("event_id") % 7).cast("string")))
    return events.publish_batches(events.coalesced(rows, "event_id"), "brand").select("brand", "key", "coalesced_count", F.col("batch").cast("long").alias("batch"))


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.train_val_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id")


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.stratified_folds(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", "vec_id", 5)


def kfold_oos_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", "embedding")
    out = folds.out_of_sample(rows, folds=5, trees=100, depth=8)
    return out.select("id", "label", "fold", F.round(F.array_max("pred_probs"), 6).alias("confidence"), argmax(F.col("pred_probs")).alias("predicted"))


def kfold_oos_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-sample probabilities of 30 rounds of boosted trees in 5 folds, and what must hold of each row's: their sum, their number and range."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", "embedding")
    out = boosting.out_of_sample(rows)
    p = F.col("pred_probs")
    return out.select("id", "label", "fold", F.round(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.size(p).cast("long").alias("classes"), F.forall(p, lambda x: (x > 0) & (x < 1)).alias("inside"))


def _digest_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id", "text")
    head = lambda sha: reconcile.checksum(sha, F.lit('"etag"'), F.col("key"))
    digest = lambda t: F.sha2(t.cast("binary"), 256)
    source = d.withColumn("_c", head(digest(F.col("text")))).select("key", "_c.algorithm", "_c.value")
    altered = F.when(F.col("doc_id") % 97 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    copied = d.where("doc_id % 101 <> 0").withColumn("_c", head(F.when(F.col("doc_id") % 89 != 0, digest(altered)))).select("key", "_c.algorithm", "_c.value")
    return source, copied


def checksum_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile(*_digest_sides(spark, sf_dir)).select("key", "algorithm", "matched", "reason")


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def hash_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 words before they are normalised, which SQL can tell; ``hash_embedding_full`` has the whole vectors."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(hash_words(F.col("text").cast("binary"), 16)).alias("position", "value"))
    return d.select("doc_id", "position", F.round("value", 9).alias("value"))


def hash_embedding_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", embedding_of(F.col("text").cast("binary"), 1280).alias("embedding"))


def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = dedup.cosine_pairs(table(spark, sf_dir, "embeddings"), 0.4, "vec_id")
    return pairs.select("a", "b", F.round("cosine", 4).alias("cosine"))


def cosine_pairs_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the vectors' first four numbers, which lie close enough together for cells to bound what is compared at a high threshold."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 4).alias("embedding"))
    pairs = dedup.cosine_pairs(rows, 0.98, "vec_id")
    return pairs.select("a", "b", F.round("cosine", 4).alias("cosine"))


def cosine_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mark_near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.4, "vec_id").select("vec_id", "near_duplicate")


def confidence_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_quality.flag(probabilities(spark, sf_dir), CLASSES, 0.3)
    return rows.select("id", "label", "predicted_label", F.round("confidence", 6).alias("confidence"), "flagged", "reason")


def confident_joint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_quality.confident_joint(probabilities(spark, sf_dir), CLASSES)


def prune_by_noise_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_quality.prune_by_noise_rate(probabilities(spark, sf_dir), CLASSES)


def label_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_quality.per_class(label_quality.flag(probabilities(spark, sf_dir), CLASSES, 0.3))


def label_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_quality.flag(probabilities(spark, sf_dir), CLASSES, 0.3)
    return label_quality.report(rows, 0.05).select("total_images", "flagged_images", "cleaned_count", "minimum_class_count", "class_count", "classes_lost", F.round("flagged_fraction", 6).alias("flagged_fraction"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c: F.when(c == 1, "done").otherwise("not_done")
    return table(spark, sf_dir, "labels").select(name(F.col("quality")).alias("label"), name(1 - F.col("toxic")).alias("prediction"), F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") % 100) / 100).alias("confidence"))


def evaluation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = evaluation.metrics(predictions(spark, sf_dir))
    c = F.col("confidence_summary")
    return m.select(
        "sample_count", F.round("accuracy", 6).alias("accuracy"), F.round("emergency_false_positive_rate", 6).alias("fp_rate"), "false_positives", "not_done_sample_count", "done_sample_count",
        c["count"].alias("confidences"), F.round(c["mean"], 6).alias("mean_confidence"), c["min"].alias("least_confidence"), c["max"].alias("most_confidence"), evaluation.quality_gate().alias("quality_gate"),
    )


def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = evaluation.report(evaluation.metrics(predictions(spark, sf_dir)))
    return r.select("schema_version", "quality_gate", F.explode("metrics.label_distribution").alias("label", "n"), F.round("model_metrics.classification_metrics.accuracy.value", 6).alias("accuracy"))


def gate_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = evaluation.with_run_facts(evaluation.metrics(predictions(spark, sf_dir)), spark.createDataFrame([], "image_path string"), spark.createDataFrame([], "ms double"))
    from ..config import Brand, Config

    gate = gates.evaluation(Config((Brand("b", "b_*"),), evaluation=Evaluation()))
    return gate.evaluate(facts).select(F.explode("violations").alias("violation"), "passed")


def approval_event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources import sinks

    r = evaluation.report(evaluation.metrics(predictions(spark, sf_dir)))
    e = sinks.approval_event(r, "b", "group", "m1", "uri", "base")
    field = lambda p: F.get_json_object("detail", f"$.{p}")
    return e.select(F.size(F.json_object_keys("detail")).cast("long").alias("keys"), field("brand_id").alias("brand_id"), field("quality_gate").alias("quality_gate"), field("sample_count").cast("long").alias("sample_count"), F.round(field("accuracy").cast("double"), 6).alias("accuracy"))


def _tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("tenant", F.col("user_id") % 5)
    since = F.col("ts") >= F.lit("2024-01-21").cast("timestamp_ntz")
    rates = drift.correction_rates(e, F.col("tenant"), F.col("event_type") == "error", since)
    probs = e.select("tenant", F.array(F.least(F.col("value") / 60, F.lit(1.0)), F.lit(0.5)).alias("pred_probs"))
    return drift.mean_confidence(probs, by=["tenant"]).join(rates, "tenant")


def drift_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = drift.step_status(_tenants(spark, sf_dir))
    return r.select("tenant", F.round("confidence", 6).alias("confidence"), F.round("correction_rate_multiplier", 6).alias("multiplier"), "level", "status")


def drift_level_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    level, reasons = drift.monitor_level(F.col("confidence"), F.col("observed"), F.col("baseline"), Drift(multiplier=1.0))
    return _tenants(spark, sf_dir).select("tenant", level.alias("level"), F.array_join(reasons, ",").alias("reasons"))


def drift_alarms_300s(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"), (F.floor(F.col("value") / 20) % 4).cast("int").alias("level"))
    r = drift.alarms(e)
    return r.select("endpoint", F.unix_timestamp("window_start").alias("window_start"), "level", "level1", "level2", "level3")


QUERIES = (
    select_curated, selection_metrics, select_lenient, brand_first_match, upload_coalesce_window, upload_normalise, in_flight_suppression, training_request_batches, train_val_split, stratified_folds, kfold_oos_rf, kfold_oos_boosted,
    checksum_reconcile, exact_duplicates, hash_embedding, hash_embedding_full, cosine_pairs, cosine_pairs_tight, cosine_dedup_keep_first, confidence_floor, confident_joint, prune_by_noise_rate, label_quality_report, label_quality_metrics,
    evaluation_metrics, evaluation_report, gate_evaluation, approval_event_fields, drift_level, drift_level_monitor, drift_alarms_300s,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES} | stores.queries() | checks.queries()


INVENTORY_SQL = """inv AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, lower(o_orderstatus) || '_' || o_orderpriority || '_0.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || '.jpg' AS key, o_orderdate AS modified FROM orders)"""
CANDIDATES_SQL = f"""{INVENTORY_SQL},
cand AS (SELECT id, key, regexp_extract(key, '^([^_]+)_(.+)_([0-9]+\\.[0-9]+)\\.jpg$', 2) AS label, regexp_extract(key, '^([^_]+)_', 1) AS source_brand, CAST(regexp_extract(key, '_([0-9]+\\.[0-9]+)\\.jpg$', 1) AS DOUBLE) AS source_confidence, modified FROM inv WHERE starts_with(key, 'o_') AND modified >= TIMESTAMP '2000-01-01' - INTERVAL 720 DAY),
elig AS (SELECT * FROM cand WHERE label IN (SELECT label FROM cand GROUP BY label HAVING count(*) >= 40))"""
PROBS_SQL = """raw AS (SELECT vec_id AS id, label AS y, list_transform(embedding[1:10], lambda x: abs(CAST(x AS DOUBLE))) AS a FROM embeddings),
p AS (SELECT id, y, list_transform(a, lambda x: x / list_sum(a)) AS p FROM raw),
best AS (SELECT id, y, p, list_max(p) AS m, list_position(p, list_max(p)) - 1 AS pred FROM p)"""
FLAGGED_SQL = f"""{PROBS_SQL}, flagged AS (SELECT id, y, pred, m, (pred <> y AND m >= 0.3) AS flagged FROM best)"""
JOINT_SQL = f"""{PROBS_SQL},
t AS (SELECT y AS j, avg(p[y + 1]) AS t FROM p GROUP BY y),
cells AS (SELECT id, y, j, p[j + 1] AS v FROM p, t WHERE p[j + 1] >= t),
pick AS (SELECT id, y, j FROM cells QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC, j) = 1),
jt AS (SELECT y AS given, j AS suggested, count(*) AS n FROM pick GROUP BY ALL)"""
PREDICTIONS_SQL = """pred AS (SELECT CASE WHEN quality = 1 THEN 'done' ELSE 'not_done' END AS label, CASE WHEN toxic = 0 THEN 'done' ELSE 'not_done' END AS prediction, CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 100) / 100 END AS confidence FROM labels),
m AS (SELECT count(*) AS sample_count, avg(CAST(label = prediction AS INT)) AS accuracy, count(*) FILTER (label = 'not_done' AND prediction = 'done') / nullif(count(*) FILTER (label = 'not_done'), 0) AS fp_rate,
  count(*) FILTER (label = 'not_done' AND prediction = 'done') AS false_positives, count(*) FILTER (label = 'not_done') AS not_done_sample_count, count(*) FILTER (label = 'done') AS done_sample_count,
  count(confidence) AS confidences, avg(confidence) AS mean_confidence, min(confidence) AS least_confidence, max(confidence) AS most_confidence FROM pred)"""
GATE_SQL = "CASE WHEN accuracy >= 0.97 AND fp_rate <= 0.05 THEN 'passed' ELSE 'failed' END"
TENANTS_SQL = """ten AS (SELECT user_id % 5 AS tenant, avg(greatest(least(value / 60, 1.0), 0.5)) AS confidence,
  avg(CAST(event_type = 'error' AS INT)) FILTER (ts >= TIMESTAMP '2024-01-21') AS observed, avg(CAST(event_type = 'error' AS INT)) FILTER (ts < TIMESTAMP '2024-01-21') AS baseline FROM events GROUP BY 1),
mult AS (SELECT *, CASE WHEN baseline > 0 AND observed IS NOT NULL THEN observed / baseline ELSE 1e308 END AS mult FROM ten)"""


def oracle_sql() -> dict[str, str]:
    return stores.oracle_sql() | checks.oracle_sql(CANDIDATES_SQL, TENANTS_SQL) | {
        "select_curated": f"""WITH {CANDIDATES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY key, id) AS r FROM elig), capped AS (SELECT * FROM r ORDER BY r, label LIMIT 233)
SELECT id, key, label, source_brand, source_confidence, strftime(modified, '%Y-%m-%d') AS modified_on FROM capped""",
        "selection_metrics": f"""WITH {CANDIDATES_SQL}, c AS (SELECT label, count(*) AS n FROM elig GROUP BY label)
SELECT CAST((SELECT sum(n) FROM c) AS BIGINT) AS dataset_size, (SELECT min(n) FROM c) AS minimum_class_count, label, n FROM c""",
        "select_lenient": f"""WITH {INVENTORY_SQL}, s AS (SELECT string_split(regexp_replace(key, '\\.[^.]+$', ''), '_') AS p FROM inv WHERE starts_with(key, 'f_'))
SELECT array_to_string(p[2:len(p) - 1], '') AS label, p[len(p)] AS confidence, count(*) AS n FROM s WHERE len(p) >= 3 AND p[1] = 'f' GROUP BY ALL""",
        "brand_first_match": """WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, url_decode(replace(url, '+', ' ')) AS decoded FROM pages),
b AS (SELECT page_id, CASE WHEN regexp_full_match(host, '.*\\.example\\.com') THEN 'shop' WHEN starts_with(host, 'blog.') THEN 'blog' WHEN starts_with(host, 'spam-') THEN 'spam' WHEN regexp_full_match(host, '.*\\.example\\.or[^a-f]') THEN 'org' END AS brand, length(decoded) AS n_decoded FROM h)
SELECT * FROM b WHERE brand IS NOT NULL""",
        "upload_coalesce_window": """WITH u AS (SELECT event_id, event_type AS brand, 'raw' AS bucket, 'u' || user_id || '/' || event_id AS key, CAST(floor(epoch(ts) / 300) AS BIGINT) AS window_number FROM events),
g AS (SELECT brand, window_number, first(bucket ORDER BY event_id) AS bucket, first(key ORDER BY event_id) AS key, CASE WHEN count(*) > 1 THEN count(*) END AS coalesced_count FROM u GROUP BY brand, window_number)
SELECT *, 'brand-' || brand || '-' || window_number || '-' || substr(sha1('curation:' || brand || ':' || window_number), 1, 12) AS display_name FROM g""",
        "upload_normalise": "SELECT event_id, 'raw' AS bucket, 'in box/' || event_type || ' ' || event_id || '.jpg' AS key FROM events",
        "in_flight_suppression": """WITH e AS (SELECT *, 'b' || user_id % 50 AS brand FROM events), last AS (SELECT brand, last(event_type ORDER BY ts, event_id) AS t FROM e GROUP BY brand),
r AS (SELECT brand, count(*) AS n FROM e WHERE event_type = 'purchase' GROUP BY brand)
SELECT r.brand, n, t IN ('view', 'click') AS skipped, CASE WHEN t IN ('view', 'click') THEN 'in_flight_execution' END AS reason FROM r JOIN last USING (brand)""",
        "training_request_batches": """WITH u AS (SELECT event_id, event_type || '-' || event_id % 7 AS brand, 'u' || user_id || '/' || event_id AS key FROM events),
g AS (SELECT brand, first(key ORDER BY event_id) AS key, CASE WHEN count(*) > 1 THEN count(*) END AS coalesced_count FROM u GROUP BY brand)
SELECT *, CAST((row_number() OVER (ORDER BY brand) - 1) // 10 AS BIGINT) AS batch FROM g""",
        "train_val_split": """SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= greatest(1, floor(count(*) OVER (PARTITION BY lang) * 0.2)) THEN 'val' ELSE 'train' END AS split FROM documents""",
        "stratified_folds": """SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1) % 5 AS INT) AS fold FROM embeddings""",
        "kfold_oos_boosted": """SELECT vec_id AS id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1) % 5 AS INT) AS fold,
  CAST(1 AS DOUBLE) AS total, (SELECT count(DISTINCT label) FROM embeddings) AS classes, true AS inside FROM embeddings WHERE label IS NOT NULL""",
        "checksum_reconcile": """WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS key, doc_id FROM documents)
SELECT key, 'SHA256' AS algorithm, NOT (doc_id % 101 = 0 OR doc_id % 89 = 0 OR doc_id % 97 = 0) AS matched, CASE WHEN doc_id % 101 = 0 THEN 'missing' WHEN doc_id % 89 = 0 THEN 'algorithm' WHEN doc_id % 97 = 0 THEN 'value' END AS reason FROM d""",
        "exact_duplicates": "SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY text) AS first_id, min(doc_id) OVER (PARTITION BY text) <> doc_id AS is_duplicate FROM documents",
        "hash_embedding": """WITH d AS (SELECT doc_id, c, sha256(unhex(lpad(hex(c), 8, '0')) || encode(text)) AS h FROM documents, range(0, 2) AS r(c))
SELECT doc_id, CAST(c * 8 + k AS INT) AS position, round(CAST(('0x' || substr(h, CAST(k * 8 + 1 AS BIGINT), 8)) AS BIGINT) / 4294967295.0 * 2 - 1, 9) AS value FROM d, range(0, 8) AS q(k)""",
        "cosine_pairs": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 4) AS cosine FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.4""",
        "cosine_pairs_tight": """WITH e AS (SELECT vec_id, CAST(embedding[1:4] AS DOUBLE[]) AS v FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 4) AS cosine FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98""",
        "cosine_dedup_keep_first": """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS MATERIALIZED (SELECT b.vec_id AS id, list(a.vec_id) AS before FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.4 GROUP BY b.vec_id),
o AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS i, before FROM e LEFT JOIN pairs ON id = vec_id),
walk AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT o.i, CASE WHEN o.before IS NOT NULL AND list_has_any(kept, o.before) THEN kept ELSE list_append(kept, o.vec_id) END FROM walk JOIN o ON o.i = walk.i + 1),
fin AS (SELECT kept FROM walk ORDER BY i DESC LIMIT 1)
SELECT vec_id, NOT list_contains(kept, vec_id) AS near_duplicate FROM e, fin""",
        "confidence_floor": f"""WITH {FLAGGED_SQL} SELECT id, CAST(y AS VARCHAR) AS label, CAST(pred AS VARCHAR) AS predicted_label, round(m, 6) AS confidence, flagged, CASE WHEN flagged THEN 'mislabel' END AS reason FROM flagged""",
        "confident_joint": f"WITH {JOINT_SQL} SELECT given, CAST(suggested AS INT) AS suggested, n FROM jt",
        "prune_by_noise_rate": f"""WITH {JOINT_SQL}, whole AS (SELECT given, sum(n) AS al FROM jt GROUP BY given), sizes AS (SELECT y, count(*) AS rws FROM p GROUP BY y),
quota AS (SELECT jt.given, jt.suggested, CAST(round(n * rws / al) AS INT) AS k FROM jt JOIN whole USING (given) JOIN sizes ON y = jt.given WHERE jt.given <> jt.suggested),
ranked AS (SELECT id, k, row_number() OVER (PARTITION BY given, suggested ORDER BY round(p[suggested + 1] - p[y + 1], 9) DESC, id) AS r FROM p JOIN quota ON y = given WHERE k > 0)
SELECT DISTINCT id FROM ranked WHERE r <= k""",
        "label_quality_report": f"WITH {FLAGGED_SQL} SELECT CAST(y AS VARCHAR) AS label, count(*) AS total, count(*) FILTER (NOT flagged) AS cleaned, count(*) FILTER (flagged) AS flagged FROM flagged GROUP BY y",
        "label_quality_metrics": f"""WITH {FLAGGED_SQL}, c AS (SELECT y, count(*) AS total, count(*) FILTER (NOT flagged) AS cleaned, count(*) FILTER (flagged) AS f FROM flagged GROUP BY y)
SELECT CAST(sum(total) AS BIGINT) AS total_images, CAST(sum(f) AS BIGINT) AS flagged_images, CAST(sum(cleaned) AS BIGINT) AS cleaned_count, min(cleaned) AS minimum_class_count, count(*) AS class_count, count(*) FILTER (cleaned = 0) AS classes_lost, round(sum(f) / sum(total), 6) AS flagged_fraction FROM c""",
        "evaluation_metrics": f"""WITH {PREDICTIONS_SQL} SELECT sample_count, round(accuracy, 6) AS accuracy, round(fp_rate, 6) AS fp_rate, false_positives, not_done_sample_count, done_sample_count, confidences, round(mean_confidence, 6) AS mean_confidence, least_confidence, most_confidence, {GATE_SQL} AS quality_gate FROM m""",
        "evaluation_report": f"""WITH {PREDICTIONS_SQL} SELECT '1.0' AS schema_version, (SELECT {GATE_SQL} FROM m) AS quality_gate, label, count(*) AS n, (SELECT round(accuracy, 6) FROM m) AS accuracy FROM pred GROUP BY label""",
        "gate_evaluation": f"""WITH {PREDICTIONS_SQL}, v AS (SELECT unnest([CASE WHEN accuracy >= 0.97 THEN NULL ELSE 'accuracy >= 0.97' END, CASE WHEN fp_rate <= 0.05 THEN NULL ELSE 'emergency_false_positive_rate <= 0.05' END,
CASE WHEN sample_count >= 100 THEN NULL ELSE 'sample_count >= 100' END, CASE WHEN not_done_sample_count >= 50 THEN NULL ELSE 'not_done_sample_count >= 50' END, CASE WHEN done_sample_count >= 50 THEN NULL ELSE 'done_sample_count >= 50' END]) AS violation FROM m)
SELECT violation, false AS passed FROM v WHERE violation IS NOT NULL""",
        "approval_event_fields": f"""WITH {PREDICTIONS_SQL} SELECT CAST(9 AS BIGINT) AS keys, 'b' AS brand_id, {GATE_SQL} AS quality_gate, sample_count, round(accuracy, 6) AS accuracy FROM m""",
        "drift_level": f"""WITH {TENANTS_SQL}, l AS (SELECT *, CASE WHEN confidence < 0.65 OR mult > 3 THEN 2 WHEN confidence < 0.7 OR mult > 1 THEN 1 ELSE 0 END AS level FROM mult)
SELECT tenant, round(confidence, 6) AS confidence, round(mult, 6) AS multiplier, CAST(level AS INT) AS level, CASE WHEN level < 2 AND mult < 1e308 THEN 'ok' ELSE 'failed' END AS status FROM l""",
        "drift_level_monitor": f"""WITH {TENANTS_SQL}, l AS (SELECT *, CASE WHEN baseline = 0 THEN observed > 0 ELSE observed >= baseline END AS spike FROM mult)
SELECT tenant, CAST(CASE WHEN spike THEN 3 WHEN confidence < 0.65 THEN 2 WHEN confidence < 0.7 THEN 1 ELSE 0 END AS INT) AS level,
concat_ws(',', CASE WHEN confidence < 0.7 THEN 'confidence_below_level1_threshold' END, CASE WHEN confidence < 0.65 THEN 'confidence_below_level2_floor' END, CASE WHEN spike THEN 'correction_rate_spike' END) AS reasons FROM l""",
        "drift_alarms_300s": """WITH s AS (SELECT event_type AS endpoint, CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS window_start, CAST(floor(value / 20) % 4 AS INT) AS level FROM events),
g AS (SELECT endpoint, window_start, max(level) AS level FROM s GROUP BY ALL) SELECT *, level >= 1 AS level1, level >= 2 AS level2, level >= 3 AS level3 FROM g""",
    }
