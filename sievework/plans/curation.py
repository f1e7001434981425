"""The gated curation run: select, embed, de-duplicate, predict, filter, drift, train, evaluate, register."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.vectors import hash_embedding
from ..operators import boosting, dedup, drift, evaluation, folds, gates, label_quality, selection, softmax
from ..sources import sinks
from ..storage import materialise

Embedder = Callable[[DataFrame], DataFrame]  # adds embedding array<float> and embedding_backend to rows with payload


def hash_embedder(width: int = 1280) -> Embedder:
    """Embeds the payload's bytes; rows without payload are an error."""

    def embed(df: DataFrame) -> DataFrame:
        v = F.when(F.col("payload").isNull(), F.raise_error(F.concat(F.lit("no payload for "), F.col("id"))).cast("array<float>")).otherwise(hash_embedding(F.col("payload"), width).cast("array<float>"))
        return df.withColumn("embedding", v).withColumn("embedding_backend", F.lit("deterministic"))

    return embed


@dataclass
class Outcome:
    manifest: DataFrame
    flagged: DataFrame
    report: DataFrame
    registry: DataFrame
    drift: DataFrame


def timed(model, rows: DataFrame) -> DataFrame:
    """The model's output and ms: what the scoring of each row took on the executor's clock."""
    clock = lambda: F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    out = model.transform(rows.withColumn("_began", clock()))
    return out.withColumn("ms", F.when(F.col("probability").isNotNull(), (clock() - F.col("_began")) / 1e6)).drop("_began")  # read after scoring, as it depends on it


def run(inventory: DataFrame, payloads: DataFrame, rates: DataFrame, config: Config, brand: str, now: datetime, out: str, embed: Embedder, model_id: str, allow_fallback: bool = False, trees: int = 100, depth: int = 8, classifier: str = "forest", head: str = "forest", training: softmax.Settings = softmax.Settings()) -> Outcome:
    """One brand's run. ``payloads``: (id, payload); ``rates``: one row (observed, baseline). A gate that fails raises after its metrics
    have been written under ``out``; later stages then never run. Ids must be integers written as text.

    Out-of-sample probabilities come from the ``classifier``, a forest or boosted trees. The model is a ``forest`` or a ``softmax`` head, which
    goes on from the checkpoints of a run that broke off and leaves class names and training metrics. It is saved under ``out``/models by
    brand and id, and the registration's result in ``out``/registration. Registry and baselines keep the rows of other brands and models.
    The model learns from the split's training rows; every cleaned row that has a file is evaluated. The files are the payloads that
    aren't null: a row of the manifest without one counts as a missing image, and any of them fails the evaluation."""
    if classifier not in ("forest", "boosted") or head not in ("forest", "softmax"):
        raise ValueError(f"unknown classifier {classifier!r} or head {head!r}")
    s = config.selection_of(brand)
    manifest = materialise(selection.select_curated(inventory, s, now), "manifest")
    sinks.metrics_then_check(selection.selection_metrics(manifest), f"{out}/selection_metrics", gates.dataset_bounds(s))
    embedded = materialise(embed(manifest.join(payloads, "id", "left")).drop("payload").withColumn("n", F.col("id").cast("long")), "embedded")
    backends = label_quality.backend_metrics(embedded)
    sinks.json_lines(backends, f"{out}/embedding_metrics")
    if not allow_fallback and not backends.first()["efficientnet_only"]:
        raise gates.GateFailed("EmbeddingBackend", ["rows were not embedded by the backbone"])
    unique = materialise(dedup.mark_near_duplicates(embedded, config.quality.cosine_threshold, "n"), "unique").where("NOT near_duplicate")
    if classifier == "boosted":
        probs = boosting.out_of_sample(unique, "label", "embedding", "n", config.quality.folds, boosting.Settings(seed=config.quality.seed))
    else:
        probs = folds.out_of_sample(unique, "label", "embedding", "n", config.quality.folds, trees, depth, config.quality.seed)
    probs = materialise(probs, "probs")
    classes = sorted(folds.classes_of(probs, "label"))
    issues = label_quality.prune_by_noise_rate(probs, classes, "n")
    flagged = materialise(label_quality.flag(probs, classes, config.quality.disagreement_floor, issues, "n"), "flagged")
    sinks.metrics_then_check(label_quality.report(flagged, config.quality.flag_threshold), f"{out}/quality_metrics", gates.label_quality(config, s))
    cleaned = flagged.where("NOT flagged")
    levels = drift.step_status(drift.mean_confidence(probs).crossJoin(rates), config.drift)  # one row each
    sinks.metrics_then_check(levels, f"{out}/drift_metrics", gates.drift(config))
    split = materialise(folds.train_val_split(cleaned, "label", "key"), "split")
    model_path = f"{out}/models/{brand}/{model_id}"
    files = payloads.where("payload is not null").select("id")
    evaluated = split.join(files.distinct(), "id", "left_semi")
    if head == "softmax":
        model, told = softmax.train(split, f"{out}/checkpoints/{brand}/{model_id}", settings=training)
        model.save(split.sparkSession, model_path)
        said = json.dumps({"brand_id": brand, **told}, sort_keys=True)
        split.sparkSession.createDataFrame([(said,)], "value string").coalesce(1).write.mode("overwrite").text(f"{model_path}/training_metrics")
        scored = model.transform(evaluated).select("label", "prediction", F.array_max("probability").alias("confidence"), "ms")
    else:
        index = F.array_position(F.array(*map(F.lit, classes)), F.col("label")) - 1
        with_vector = lambda d: d.withColumn("_x", array_to_vector(F.col("embedding").cast("array<double>"))).withColumn("_y", index.cast("double"))
        model = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=config.quality.seed).fit(with_vector(split.where("split = 'train'")))
        model.write().overwrite().save(model_path)
        name = F.element_at(F.array(*map(F.lit, classes)), F.col("prediction").cast("int") + 1)
        scored = timed(model, with_vector(evaluated))
        scored = scored.select("label", name.alias("prediction"), F.array_max(vector_to_array("probability")).alias("confidence"), "ms")
    scored = materialise(scored, "scored")
    facts = evaluation.with_run_facts(evaluation.metrics(scored, config.evaluation), evaluation.missing_files(manifest, files, "id"), scored)
    facts = materialise(evaluation.with_aborts(facts, config.evaluation), "facts")
    report = materialise(evaluation.report(facts, config.evaluation), "report")
    sinks.json_lines(report, f"{out}/evaluation")
    sinks.metrics_then_check(facts, f"{out}/evaluation_metrics", gates.evaluation(config))
    registry = sinks.registration(brand, config.brand(brand).model_package_group, model_id, report, now.isoformat())
    sinks.register(registry, sinks.baseline(report, brand, model_id, now.isoformat()), out, f"{brand}-{model_id}")
    sinks.registration_result(registry, model_path, f"{out}/baselines", f"{out}/registration/{brand}/{model_id}")
    return Outcome(manifest, flagged, report, registry, levels)
