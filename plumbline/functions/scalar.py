"""Column expressions: hashing, ratios, severities, feature engineering."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.config import (
    MAD_SCALE,
    CanaryThresholds,
    DriftThresholds,
    FeatureConfig,
)

HASH_RANGE = 4294967296.0  # 2**32


def hash32(key: Column | str, seed: Column | int | str) -> Column:
    """32-bit integer from md5(key ':' seed); the same on every engine and retry."""
    key = F.col(key) if isinstance(key, str) else key
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat(key.cast("string"), F.lit(":"), seed.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_unit(key: Column | str, seed: Column | int | str) -> Column:
    """Uniform number in [0, 1) that depends only on the row key and the seed."""
    return hash32(key, seed) / F.lit(HASH_RANGE)


def clamped_ratio(top: Column, bottom: Column, floor: float) -> Column:
    return top / F.greatest(bottom, F.lit(floor))


def severity(psi: Column, ks: Column, limits: DriftThresholds = DriftThresholds()) -> Column:
    return (
        F.when((psi >= limits.psi_alert) | (ks >= limits.ks_alert), "alert")
        .when((psi >= limits.psi_warning) | (ks >= limits.ks_warning), "warning")
        .otherwise("ok")
    )


def batch_severity(
    prediction_severity: Column,
    n_alerts: Column,
    n_warnings: Column,
    limits: DriftThresholds = DriftThresholds(),
) -> Column:
    return (
        F.when((prediction_severity == "alert") | (n_alerts > limits.alert_features), "alert")
        .when((prediction_severity == "warning") | (n_warnings > limits.warning_features), "warning")
        .otherwise("ok")
    )


def canary_fails(
    mean_shift: Column,
    pred_psi: Column,
    latency_ratio: Column,
    correlation: Column,
    limits: CanaryThresholds = CanaryThresholds(),
) -> Column:
    """Names of the failed checks. A correlation that cannot be computed fails."""
    no_corr = correlation.isNull() | F.isnan(correlation)
    tests = F.array(
        F.when(F.abs(mean_shift) > limits.max_mean_shift, F.lit("mean_shift")),
        F.when(pred_psi > limits.max_pred_psi, F.lit("prediction_psi")),
        F.when(latency_ratio > limits.max_latency_ratio, F.lit("latency")),
        F.when(no_corr | (correlation < limits.min_correlation), F.lit("correlation")),
    )
    return F.array_compact(tests)


def joined_or_none(items: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(items, ","), F.lit("")), F.lit("none"))


def modified_z(x: Column, median: Column | float, mad: Column | float) -> Column:
    median = median if isinstance(median, Column) else F.lit(median)
    mad = mad if isinstance(mad, Column) else F.lit(mad)
    return F.when(mad == 0, F.lit(0.0)).otherwise(F.lit(MAD_SCALE) * (x - median) / mad)


def yeo_johnson(x: Column, lam: Column | float) -> Column:
    """Yeo-Johnson power transform of ``x`` for a given lambda."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    tiny = F.lit(1e-12)
    up = F.when(F.abs(lam) < tiny, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    mirror = F.lit(2.0) - lam
    down = F.when(F.abs(mirror) < tiny, -F.log1p(-x)).otherwise(
        -(F.pow(-x + 1, mirror) - 1) / mirror
    )
    return F.when(x >= 0, up).otherwise(down)


# --- feature engineering ----------------------------------------------------


def unary_features(cfg: FeatureConfig = FeatureConfig()) -> list[Column]:
    out = []
    for f in cfg.unary:
        x = F.col(f)
        out += [
            F.log1p(F.abs(x)).alias(f"{f}_log"),
            F.sqrt(F.abs(x)).alias(f"{f}_sqrt"),
            (x * x).alias(f"{f}_sq"),
        ]
    return out


def pair_features(cfg: FeatureConfig = FeatureConfig()) -> list[Column]:
    out = []
    for a, b in combinations(cfg.pairs, 2):
        out += [
            (F.col(a) * F.col(b)).alias(f"{a}_x_{b}"),
            (F.col(a) / (F.abs(F.col(b)) + F.lit(cfg.ratio_eps))).alias(f"{a}_div_{b}"),
        ]
    return out


def row_stats(cfg: FeatureConfig = FeatureConfig()) -> list[Column]:
    """Mean, sample std, max, min, range over the non-missing base columns of a row."""
    present = [F.when(~F.isnan(F.col(c)), F.col(c)) for c in cfg.base]
    zero = F.lit(0.0)
    n = sum((p.isNotNull().cast("int") for p in present[1:]), present[0].isNotNull().cast("int"))
    n = n.cast("double")
    total = sum((F.coalesce(p, zero) for p in present[1:]), F.coalesce(present[0], zero))
    mean = total / F.nullif(n, zero)
    dev = [F.coalesce((p - mean) * (p - mean), zero) for p in present]
    var = sum(dev[1:], dev[0]) / F.nullif(F.greatest(n - 1, zero), zero)
    high, low = F.greatest(*present), F.least(*present)
    return [
        mean.alias("row_mean"),
        F.sqrt(var).alias("row_std"),
        high.alias("row_max"),
        low.alias("row_min"),
        (high - low).alias("row_range"),
    ]


def weighted_sum(cfg: FeatureConfig = FeatureConfig()) -> Column:
    terms = [F.lit(w) * F.col(f) for f, w in cfg.weights.items()]
    return sum(terms[1:], terms[0]).alias("weighted_top")


def engineered_names(cfg: FeatureConfig = FeatureConfig()) -> list[str]:
    names = list(cfg.base)
    names += [f"{f}_{suffix}" for f in cfg.unary for suffix in ("log", "sqrt", "sq")]
    names += [f"{a}_{op}_{b}" for a, b in combinations(cfg.pairs, 2) for op in ("x", "div")]
    return names + ["row_mean", "row_std", "row_max", "row_min", "row_range", "weighted_top"]
