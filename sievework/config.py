"""Settings, checked before any job starts."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

REQUIRED_SECTIONS = ("brands", "data_selection", "quality", "evaluation", "drift")
# Ranges that gate literals must lie in.
LITERAL_RANGES = {
    "accuracy": (0.90, 1.0),
    "emergency_false_positive_rate": (0.0, 0.10),
    "latency_ms": (1, 5000),
    "confidence": (0.5, 1.0),
    "correction_rate_multiplier": (1, 10),
    "flagged_fraction": (0.0, 0.10),
}


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def fraction(value: float, name: str) -> float:
    _check(isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and 0 < value <= 1, f"{name} must be in (0, 1]")
    return float(value)


def probability(value: float, name: str) -> float:
    _check(isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and 0 <= value <= 1, f"{name} must be in [0, 1]")
    return float(value)


def positive(value: float, name: str) -> float:
    _check(isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and value > 0, f"{name} must be positive and finite")
    return float(value)


def at_least(value: int, least: int, name: str) -> int:
    _check(isinstance(value, int) and not isinstance(value, bool) and value >= least, f"{name} must be an integer of at least {least}")
    return value


@dataclass(frozen=True)
class Brand:
    id: str
    naming_pattern: str
    model_package_group: str = ""


@dataclass(frozen=True)
class Selection:
    naming_pattern: str
    recency_months: int
    min_per_class: int
    target_min: int
    target_max: int

    def __post_init__(self) -> None:
        at_least(self.recency_months, 0, "recency_months")
        at_least(self.min_per_class, 1, "min_per_class")
        at_least(self.target_min, 1, "target_min")
        _check(self.target_max >= self.target_min, "target_max is below target_min")


@dataclass(frozen=True)
class Drift:
    level1_floor: float = 0.65
    level2_threshold: float = 0.70
    baseline_confidence: float = 0.80
    multiplier: float = 3.0

    def __post_init__(self) -> None:
        for name in ("level1_floor", "level2_threshold", "baseline_confidence"):
            probability(getattr(self, name), name)
        positive(self.multiplier, "multiplier")
        _check(self.baseline_confidence >= self.level1_floor, "baseline_confidence is below level1_floor")
        _check(self.level2_threshold >= self.level1_floor, "level2_threshold is below level1_floor")


@dataclass(frozen=True)
class Quality:
    flag_threshold: float = 0.05
    disagreement_floor: float = 0.50
    cosine_threshold: float = 0.99
    folds: int = 5
    seed: int = 2026

    def __post_init__(self) -> None:
        fraction(self.flag_threshold, "flag_threshold")
        fraction(self.disagreement_floor, "disagreement_floor")
        fraction(self.cosine_threshold, "cosine_threshold")
        at_least(self.folds, 2, "folds")


@dataclass(frozen=True)
class Evaluation:
    accuracy: float = 0.97
    false_positive_rate: float = 0.05
    latency_ms: float = 1000.0
    least_samples: int = 100
    least_per_class: int = 50
    hazard_label: str = "not_done"
    safe_label: str = "done"

    def __post_init__(self) -> None:
        probability(self.accuracy, "accuracy")
        probability(self.false_positive_rate, "false_positive_rate")
        positive(self.latency_ms, "latency_ms")


@dataclass(frozen=True)
class Config:
    brands: tuple[Brand, ...]
    selection: dict = field(default_factory=dict)
    quality: Quality = Quality()
    evaluation: Evaluation = Evaluation()
    drift: Drift = Drift()

    def brand(self, brand_id: str) -> Brand:
        for b in self.brands:
            if b.id == brand_id:
                return b
        raise ValueError(f"unknown brand {brand_id!r}; known: {', '.join(sorted(b.id for b in self.brands))}")

    def selection_of(self, brand_id: str) -> Selection:
        return Selection(self.brand(brand_id).naming_pattern, **self.selection)


def load(path: str) -> Config:
    """A YAML file with the sections ``REQUIRED_SECTIONS``; missing ones are named in the error."""
    import yaml

    with open(path) as f:
        found = yaml.safe_load(f) or {}
    missing = [s for s in REQUIRED_SECTIONS if s not in found]
    _check(not missing, f"missing sections: {', '.join(missing)}")
    brands = tuple(Brand(**b) for b in found["brands"])
    _check(len({b.id for b in brands}) == len(brands), "brand ids repeat")
    return Config(brands, dict(found["data_selection"]), Quality(**found["quality"]), Evaluation(**found["evaluation"]), Drift(**found["drift"]))


def relaxed(config: dict[str, float], floors: dict[str, tuple[str, float]]) -> list[str]:
    """Names of settings weaker than their production floor; floors: name -> ('>=' or '<=', value)."""
    return sorted(n for n, (op, v) in floors.items() if (config[n] < v if op == ">=" else config[n] > v))


def missing(required: set[str] | tuple[str, ...], present: set[str] | dict) -> list[str]:
    """Required names (sections, steps, parameters) that aren't present."""
    return sorted(set(required) - set(present))


def forbidden(names: set[str] | tuple[str, ...], present: set[str] | dict) -> list[str]:
    """Names that must not be set but are."""
    return sorted(set(names) & set(present))


def check_relaxed(config: dict[str, float], floors: dict[str, tuple[str, float]], name: str, production_name: str, acknowledged: bool = False) -> list[str]:
    """The relaxed settings; with any, the run has to acknowledge them and to go by another name than the production run's."""
    weak = relaxed(config, floors)
    if weak:
        _check(acknowledged, f"weaker than in production, which has to be acknowledged: {', '.join(weak)}")
        _check(name != production_name, f"a run with relaxed settings can't be named {production_name!r}")
    return weak
