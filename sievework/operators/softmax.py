"""A softmax head over embeddings: trained by passes over the rows, saved every few epochs, and continued where a run broke off.

An epoch is one pass: tasks sum loss, hits and gradient over their rows, the sums of 32 groups of tasks meet, and the driver adds these up in a fixed order
and takes one step of Adam. A checkpoint has all that the next epoch depends on, so an interrupted run ends where an unbroken one does.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers
from ..storage import materialise

GROUPS = 32  # partial sums that reach the driver in a pass, at most
# Adam's decay rates and the term that keeps it from dividing by nothing.
DECAY, DECAY_SQUARE, TINY = 0.9, 0.999, 1e-7


@dataclass(frozen=True)
class Settings:
    epochs: int = 50
    every: int = 5  # epochs between checkpoints
    rate: float = 0.05
    seed: int = 2026


@dataclass
class State:
    """Weights (class, width + 1; the last column is the constant) and what Adam remembers, after so many epochs."""

    epoch: int
    weights: np.ndarray
    mean: np.ndarray
    square: np.ndarray

    def step(self, gradient: np.ndarray, rate: float) -> "State":
        t = self.epoch + 1
        mean = DECAY * self.mean + (1 - DECAY) * gradient
        square = DECAY_SQUARE * self.square + (1 - DECAY_SQUARE) * gradient**2
        move = mean / (1 - DECAY**t) / (np.sqrt(square / (1 - DECAY_SQUARE**t)) + TINY)
        return State(t, self.weights - rate * move, mean, square)


def probabilities(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = x @ weights[:, :-1].T + weights[:, -1]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Head:
    """A trained head. ``transform`` adds probability (array in the order of ``classes``), prediction and ms, the share of its batch's time that
    scoring a row took on the executor's clock."""

    classes: list[str]
    weights: np.ndarray

    def transform(self, df: DataFrame, vec_col: str = "embedding") -> DataFrame:
        weights = self.weights

        @F.pandas_udf("probability array<double>, ms double")
        def score(v: pd.Series) -> pd.DataFrame:
            began = time.perf_counter()
            p = probabilities(weights, np.stack(v.to_numpy()).astype(np.float64)) if len(v) else np.zeros((0, len(weights)))
            took = (time.perf_counter() - began) * 1000 / max(1, len(v))
            return pd.DataFrame({"probability": list(p), "ms": took})

        out = df.withColumn("_s", score(vec_col)).withColumn("probability", F.col("_s.probability")).withColumn("ms", F.col("_s.ms")).drop("_s")
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return out.withColumn("prediction", F.element_at(F.array(*map(F.lit, self.classes)), best))

    def save(self, spark: SparkSession, path: str) -> None:
        """Weights under ``path``/weights and the classes' names, in order, under ``path``/class_names."""
        _write(spark, f"{path}/weights", "class int, weights array<double>", [(i, w.tolist()) for i, w in enumerate(self.weights)])
        spark.createDataFrame([(json.dumps(self.classes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/class_names")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Head":
        classes = json.loads(spark.read.text(f"{path}/class_names").first()[0])
        return Head(classes, np.array([r["weights"] for r in spark.read.parquet(f"{path}/weights").orderBy("class").collect()]))


def _write(spark: SparkSession, path: str, kind: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(path)


def save_checkpoint(spark: SparkSession, folder: str, state: State, classes: list[str]) -> None:
    row = (state.epoch, classes, *(a.ravel().tolist() for a in (state.weights, state.mean, state.square)))
    _write(spark, f"{folder}/epoch-{state.epoch:03d}.weights.parquet", "epoch int, classes array<string>, weights array<double>, mean array<double>, square array<double>", [row])


def load_checkpoint(spark: SparkSession, folder: str, classes: list[str]) -> State | None:
    """The state of the greatest epoch there; nothing without any. Other classes than now are an error."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    path = readers.latest_checkpoint(listing).first()["path"]
    if path is None:
        return None
    row = spark.read.parquet(path).first()
    if row["classes"] != classes:
        raise ValueError(f"{path} is of the classes {row['classes']}, not {classes}")
    return State(row["epoch"], *(np.array(row[c]).reshape(len(classes), -1) for c in ("weights", "mean", "square")))


def _sums(table: DataFrame, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Of training and validation rows each: rows, loss, hits; and the gradient over training rows."""
    shape = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(6 + weights.size), None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), dtype="<f4").reshape(batch.num_rows, -1).astype(np.float64)
            y, training = batch.column("y").to_numpy(), batch.column("training").to_numpy(zero_copy_only=False)
            p = probabilities(weights, x)
            loss, hit = -np.log(p[np.arange(len(y)), y]), p.argmax(axis=1) == y
            for i, own in ((0, training), (3, ~training)):
                total[i : i + 3] += own.sum(), loss[own].sum(), hit[own].sum()
            p[np.arange(len(y)), y] -= 1
            p = p[training]
            total[6:] += np.concatenate([p.T @ x[training], p.sum(axis=0)[:, None]], axis=1).ravel()
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([part % GROUPS], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "g", "sums"])

    def add(found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("part").to_numpy(), kind="stable").tolist()
        blobs = found.column("sums").to_pylist()
        total = np.sum([np.frombuffer(blobs[i]) for i in order], axis=0)
        return pa.table({"g": found.column("g")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    groups = table.mapInArrow(run, "part int, g int, sums binary").groupBy("g").applyInArrow(add, "g int, sums binary").collect()  # GROUPS rows at most
    total = np.sum([np.frombuffer(r["sums"]) for r in sorted(groups, key=lambda r: r["g"])], axis=0) if groups else np.zeros(6 + weights.size)
    return {"training": total[:3], "validation": total[3:6], "gradient": total[6:].reshape(shape)}


def _rates(sums: np.ndarray) -> tuple[float, float]:
    """(loss, accuracy) over rows; NaN without any."""
    return (float(sums[1] / sums[0]), float(sums[2] / sums[0])) if sums[0] else (math.nan, math.nan)


def train(data: DataFrame, checkpoints: str, label_col: str = "label", vec_col: str = "embedding", split_col: str = "split", settings: Settings = Settings()) -> tuple[Head, dict]:
    """(head, metrics) from rows whose split is 'train' or 'val'. Goes on from the greatest checkpoint in ``checkpoints``, if there is one.

    Training stops when loss or weights are no longer finite; the head then has the weights of the last epoch that was, and metrics say so.
    Both splits need the same classes. Rows with a null label or vector take no part; vectors of different widths are an error."""
    spark = data.sparkSession
    rows = data.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<float>").alias("v"), (F.col(split_col) == "train").alias("training"))
    if not readers.same_classes(rows.where("training"), rows.where("NOT training")):
        raise ValueError("training and validation rows don't have the same classes")
    widths = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if widths["least"] is None or widths["least"] != widths["most"]:
        raise ValueError(f"vectors of {widths['least']} to {widths['most']} numbers; one width is needed")
    classes = sorted(r[0] for r in rows.select("label").distinct().collect())
    index = (F.array_position(F.array(*map(F.lit, classes)), F.col("label")) - 1).cast("int")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<f4").reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("training"), batch.column("part"), pa.array([v.tobytes() for v in x], pa.binary())], names=["y", "training", "part", "x"])

    # rows lie in an order of their own, and sums are added in the order of parts: the same rows give the same weights in every run
    spread = F.pmod(F.xxhash64("v", "label"), F.lit(1 << 20)).cast("int")
    table = rows.select(index.alias("y"), "training", "v", spread.alias("order")).repartitionByRange("order").sortWithinPartitions("order", "y", "training", "v").withColumn("part", F.spark_partition_id())
    table = materialise(table.mapInArrow(packed, "y int, training boolean, part int, x binary"), "softmax")
    blank = np.zeros((len(classes), widths["most"] + 1))
    state = load_checkpoint(spark, checkpoints, classes) or State(0, np.random.default_rng(settings.seed).normal(0, 0.01, blank.shape), blank, blank)
    if state.weights.shape != blank.shape:
        raise ValueError(f"the checkpoint has weights for {state.weights.shape[1] - 1} numbers, the vectors have {widths['most']}")
    resumed, history, stopped = state.epoch, [], False
    while state.epoch < settings.epochs and not stopped:
        sums = _sums(table, state.weights)
        loss, accuracy = _rates(sums["training"])
        after = state.step(sums["gradient"] / max(1.0, sums["training"][0]), settings.rate)
        stopped = not (math.isfinite(loss) and np.isfinite(after.weights).all())
        if stopped:
            break
        history.append((after.epoch, loss, accuracy, *_rates(sums["validation"])))
        state = after
        if state.epoch % settings.every == 0:
            save_checkpoint(spark, checkpoints, state, classes)
    last = _sums(table, state.weights)
    loss, accuracy = _rates(last["training"])
    val_loss, val_accuracy = _rates(last["validation"])
    metrics = {
        "resumed_from_epoch": resumed, "final_epoch": state.epoch, "stopped_on_nan": stopped, "settings": asdict(settings), "class_names": classes,
        "metrics": {"loss": loss, "accuracy": accuracy, "val_loss": val_loss, "val_accuracy": val_accuracy}, "history": [h[1] for h in history],
    }
    return Head(classes, state.weights), metrics
