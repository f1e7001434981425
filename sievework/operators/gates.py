"""Gates: named conditions between a metric and a literal. Null and NaN never pass."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LITERAL_RANGES, Config, Selection
from .label_quality import DETECTOR


class GateFailed(RuntimeError):
    def __init__(self, gate: str, violations: list[str]):
        super().__init__(f"{gate}: {'; '.join(violations)}")
        self.gate, self.violations = gate, violations


@dataclass(frozen=True)
class Condition:
    metric: str
    op: str
    value: float | str

    def __post_init__(self) -> None:
        if self.op not in (">=", "<=", "=="):
            raise ValueError(f"unknown comparison {self.op}")
        if isinstance(self.value, Column) or (isinstance(self.value, float) and not math.isfinite(self.value)):
            raise ValueError("the right side of a condition is a finite literal")

    def passes(self, df: DataFrame) -> Column:
        left, right = F.col(self.metric), F.lit(self.value)
        ok = {">=": left >= right, "<=": left <= right, "==": left == right}[self.op]
        if df.schema[self.metric].dataType.typeName() in ("double", "float"):
            ok = ok & ~F.isnan(left)
        return F.coalesce(ok, F.lit(False))


@dataclass(frozen=True)
class Gate:
    name: str
    conditions: tuple[Condition, ...]

    def evaluate(self, metrics: DataFrame) -> DataFrame:
        """The metrics with violations (array of '<metric> <op> <value>') and passed."""
        said = [F.when(~c.passes(metrics), F.lit(f"{c.metric} {c.op} {c.value}")) for c in self.conditions]
        out = metrics.withColumn("violations", F.array_compact(F.array(*said)))
        return out.withColumn("passed", F.size("violations") == 0)

    def require(self, metrics: DataFrame) -> None:
        rows = self.evaluate(metrics).select("violations").limit(2).collect()
        if len(rows) != 1:
            raise GateFailed(self.name, [f"{len(rows)} metrics rows instead of one"])
        if rows[0]["violations"]:
            raise GateFailed(self.name, rows[0]["violations"])


def dataset_bounds(s: Selection) -> Gate:
    return Gate("DatasetBounds", (Condition("dataset_size", ">=", s.target_min), Condition("dataset_size", "<=", s.target_max), Condition("minimum_class_count", ">=", s.min_per_class)))


def label_quality(c: Config, s: Selection) -> Gate:
    return Gate("LabelQuality", (Condition("flagged_fraction", "<=", c.quality.flag_threshold), Condition("detector", "==", DETECTOR), Condition("cleaned_count", ">=", s.target_min), Condition("minimum_class_count", ">=", s.min_per_class)))


def drift(c: Config) -> Gate:
    return Gate("Drift", (Condition("confidence", ">=", c.drift.level1_floor), Condition("correction_rate_multiplier", "<=", c.drift.multiplier)))


def evaluation(c: Config) -> Gate:
    e = c.evaluation
    return Gate("Evaluation", (
        Condition("accuracy", ">=", e.accuracy), Condition("emergency_false_positive_rate", "<=", e.false_positive_rate), Condition("latency_ms", "<=", e.latency_ms),
        Condition("sample_count", ">=", e.least_samples), Condition("not_done_sample_count", ">=", e.least_per_class), Condition("done_sample_count", ">=", e.least_per_class), Condition("missing_images", "<=", 0),
    ))


def check_literals(gates: list[Gate], required: set[str] | None = None) -> list[str]:
    """What is wrong with the gates' literals: out of the policy ranges, or a required metric that no gate has."""
    seen, wrong = set(), []
    for g in gates:
        for c in g.conditions:
            seen.add(c.metric)
            if c.metric in LITERAL_RANGES:
                low, high = LITERAL_RANGES[c.metric]
                if isinstance(c.value, (str, bool)) or not low <= c.value <= high:
                    wrong.append(f"{g.name}: {c.metric} {c.value} is outside {low} to {high}")
    return wrong + [f"no condition on {m}" for m in sorted((set(LITERAL_RANGES) if required is None else required) - seen)]
