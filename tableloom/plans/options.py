"""Options of the stages, with the reference defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from tableloom.operators.models import ModelSizes


@dataclass(frozen=True)
class PrepareOptions:
    missing_strategy: str = "auto"
    missing_threshold: float = 0.5
    neighbours: int = 5
    outlier_method: str = "iqr"
    cap_outliers: bool = True
    onehot_threshold: int = 10
    scale_features: bool = True
    scaler: str = "auto"
    derive_features: bool = True
    derived_pairs: int = 3
    derived_singles: int = 5
    approximate_quantiles: bool = False

    def __post_init__(self) -> None:
        choices = {
            "missing_strategy": ("auto", "median", "knn"),
            "outlier_method": ("auto", "none", "iqr", "zscore"),
            "scaler": ("auto", "standard", "robust"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}")


@dataclass(frozen=True)
class ModelOptions:
    task: str = "auto"
    test_size: float = 0.2
    seed: int = 42
    cv_folds: int = 5
    models: tuple[str, ...] = ()
    sizes: ModelSizes = field(default_factory=ModelSizes)
    parallel: int = 4


@dataclass(frozen=True)
class ExplainOptions:
    rows: int = 100
    background: int = 50
    permutations: int = 10
    instances: int = 5
    samples: int = 5000
    seed: int = 42
