"""Fixed values and small frozen settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: results are only right if these match --------------------

FEATURES = [f"feature_{i}" for i in range(20)]
TARGET = "target"

# Features that get log / sqrt / square columns.
UNARY_FEATURES = [
    "feature_2", "feature_13", "feature_16", "feature_9",
    "feature_3", "feature_18", "feature_11", "feature_5",
]
# Features whose six pairs get product and ratio columns.
PAIR_FEATURES = ["feature_2", "feature_13", "feature_9", "feature_11"]
WEIGHTED_SUM = {"feature_2": 0.50, "feature_13": 0.30, "feature_16": 0.15, "feature_9": 0.05}
RATIO_EPS = 1e-6

PSI_BINS = 10
PSI_EPS = 1e-6
METRIC_EPS = 1e-8
R2_CEILING = 0.92

IQR_FACTOR = 1.5
MAD_SCALE = 0.6745
MAD_CUTOFF = 3.5
NONLINEARITY_GAP = 0.05
ETA_FINDING = 0.10
SIGNIFICANCE = 0.05
AGREEMENT_Z = 1.96
MEAN_SHIFT_FLAG = 0.1
MIN_CANARY_ROWS_FOR_PSI = 10
LATENCY_FLOOR = 1e-6

RIDGE_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0]
KMEANS_SWEEP = [2, 3, 4, 5, 6]


@dataclass(frozen=True)
class DriftThresholds:
    psi_warning: float = 0.10
    psi_alert: float = 0.25
    ks_warning: float = 0.10
    ks_alert: float = 0.20
    # a batch is an alert above this many alerting features, a warning above
    # this many warning features
    alert_features: int = 2
    warning_features: int = 3


@dataclass(frozen=True)
class CanaryThresholds:
    max_mean_shift: float = 1.5
    max_pred_psi: float = 0.25
    max_latency_ratio: float = 2.0
    min_correlation: float = 0.85


@dataclass(frozen=True)
class CanaryStage:
    day: int
    champion_share: float


CANARY_STAGES = [
    CanaryStage(1, 0.95),
    CanaryStage(2, 0.75),
    CanaryStage(3, 0.50),
    CanaryStage(4, 0.05),
]


@dataclass(frozen=True)
class FeatureConfig:
    base: list[str] = field(default_factory=lambda: list(FEATURES))
    unary: list[str] = field(default_factory=lambda: list(UNARY_FEATURES))
    pairs: list[str] = field(default_factory=lambda: list(PAIR_FEATURES))
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTED_SUM))
    ratio_eps: float = RATIO_EPS
