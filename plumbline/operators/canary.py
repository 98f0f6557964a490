"""Staged rollout of a challenger: health per stage, final gate, promotion events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import (
    CANARY_STAGES,
    MIN_CANARY_ROWS_FOR_PSI,
    CanaryStage,
    CanaryThresholds,
)
from plumbline.functions.scalar import canary_fails, joined_or_none
from plumbline.operators.drift import decile_edges, psi_of_counts, with_bins
from plumbline.operators.longform import corr_sql, finite_sql, stack

DECISION_SCHEMA = (
    "day int, champion_share double, canary_share double, n_champion bigint, n_canary bigint,"
    " mean_shift double, pred_psi double, latency_ratio double, correlation double,"
    " fails array<string>, failed_checks string, healthy boolean, reason string, decision string"
)


def _arm_sql(key: str, share: float, seed: int) -> str:
    digest = f"md5(concat(cast(`{key}` as string), ':{seed}'))"
    u = f"cast(conv(substring({digest}, 1, 8), 16, 10) as bigint) / 4294967296.0D"
    return f"if({u} < {share!r}D, 1, 0)"


def stage_share(stage: CanaryStage) -> float:
    return round(1.0 - stage.champion_share, 12)


def canary_predictions(
    df: DataFrame, key: str, champ: str, chall: str,
    stages: Sequence[CanaryStage] = CANARY_STAGES, seed: int = 42, nested: bool = False,
) -> DataFrame:
    """(key, day, arm, champ, chall): which model served each row at every stage.

    Each stage draws its own split unless ``nested``, where rows only ever move
    towards the challenger.
    """
    return stack(df, [key, champ, chall], [
        {
            "day": str(s.day),
            "arm": _arm_sql(key, stage_share(s), seed if nested else seed + s.day),
        }
        for s in stages
    ]).selectExpr(f"`{key}`", "day", "arm", f"`{champ}` as champ", f"`{chall}` as chall")


def canary_health(
    df: DataFrame, key: str, champ: str, chall: str,
    stages: Sequence[CanaryStage] = CANARY_STAGES,
    latency_ratio: dict[int, float] | float = 1.0,
    thresholds: CanaryThresholds = CanaryThresholds(),
    seed: int = 42,
    nested: bool = False,
) -> DataFrame:
    """One health row per stage from a single pass over the predictions.

    Champion deciles come first (exact, driver-sized). Then every row contributes
    its champion bin once and its challenger bin to each stage it is served by.
    """
    both = df.selectExpr(f"`{key}`", f"{finite_sql(champ)} as champ", f"{finite_sql(chall)} as chall")
    edges = decile_edges(both, ["champ"])["champ"]
    flat = len(edges) < 3
    binned = with_bins(both, {"champ": edges, "chall": edges})
    records = []
    for s in stages:
        arm = _arm_sql(key, stage_share(s), seed if nested else seed + s.day)
        lat = latency_ratio if isinstance(latency_ratio, float) else latency_ratio[s.day]
        records.append({
            "day": str(s.day), "champion_share": f"{s.champion_share!r}D",
            "canary_share": f"{stage_share(s)!r}D", "latency_ratio": f"{lat!r}D", "arm": arm,
        })
    k = 1 if flat else len(edges) - 1
    ref = ", ".join(f"count_if(champ__bin = {i})" for i in range(k))
    cur = ", ".join(f"count_if(arm = 1 and chall__bin = {i})" for i in range(k))
    served = "arm = 1 and champ is not null and chall is not null"
    sums = stack(binned, ["champ", "chall", "champ__bin", "chall__bin"], records).groupBy(
        "day", "champion_share", "canary_share", "latency_ratio"
    ).agg(*[
        F.expr(e) for e in (
            "count_if(arm = 0) as n_champion", "count_if(arm = 1) as n_canary",
            f"avg(if({served}, chall, null)) - avg(if({served}, champ, null)) as shift",
            corr_sql(f"if({served}, champ, null)", f"if({served}, chall, null)") + " as r",
            f"array({ref}) as rc", f"array({cur}) as cc",
        )
    ])
    total = "aggregate({0}, 0L, (a, x) -> a + x)"
    psi = psi_of_counts(F.col("rc"), F.col("cc"), F.expr(total.format("rc")), F.expr(total.format("cc")))
    measured = sums.withColumns({
        "mean_shift": F.when(F.col("n_canary") > 0, F.col("shift")),
        "pred_psi": F.when(F.col("n_canary") >= MIN_CANARY_ROWS_FOR_PSI, psi)
        .when(F.col("n_canary") > 0, 0.0),
        "correlation": F.when(F.col("n_canary") == 1, 1.0).when(F.col("n_canary") > 1, F.col("r")),
    })
    checks = canary_fails(
        F.col("mean_shift"), F.col("pred_psi"), F.col("latency_ratio"), F.col("correlation"), thresholds
    )
    judged = measured.withColumn(
        "fails", F.when(F.col("n_canary") > 0, checks).otherwise(F.expr("cast(array() as array<string>)"))
    ).withColumn("healthy", F.size("fails") == 0)
    return judged.select(
        F.col("day").cast("int"), "champion_share", "canary_share", "n_champion", "n_canary",
        "mean_shift", "pred_psi",
        F.when(F.col("n_canary") > 0, F.col("latency_ratio")).alias("latency_ratio"),
        "correlation", "fails", joined_or_none(F.col("fails")).alias("failed_checks"), "healthy",
        F.when(F.col("n_canary") == 0, "no canary traffic yet").alias("reason"),
        F.when(F.col("healthy"), "promote").otherwise("rollback").alias("decision"),
    )


def promotion_gate(decisions: DataFrame) -> DataFrame:
    """Promote only if every stage with canary rows was healthy and there was one."""
    evidence = F.col("n_canary") > 0
    gate = decisions.agg(
        F.count_if(evidence).alias("n_evidence"),
        F.count_if(~F.col("healthy")).alias("n_failed"),
        F.array_sort(F.collect_list(F.when(~F.col("healthy"), F.col("day")))).alias("failed_days"),
    )
    ok = (F.col("n_evidence") > 0) & (F.col("n_failed") == 0)
    return gate.select(
        "n_evidence", "n_failed", "failed_days", ok.alias("promoted"),
        F.when(ok, "promote_challenger").otherwise("rollback_keep_champion").alias("action"),
    )


def audit_rows(decisions: DataFrame, run_id: str, as_of: str, champion: str, challenger: str) -> DataFrame:
    """Decision rows with run, time and versions, ready to append to the audit table."""
    return decisions.select(
        F.lit(run_id).alias("run_id"), "*", F.lit(as_of).cast("timestamp").alias("timestamp"),
        F.lit(champion).alias("champion_version"), F.lit(challenger).alias("challenger_version"),
    )


def better_on_validation(metrics_new: DataFrame, metrics_old: DataFrame, metric: str = "r2") -> DataFrame:
    """A retrained model replaces the champion only if it is better on labelled rows."""
    new, old = f"new_{metric}", f"old_{metric}"
    return metrics_new.select(F.col(metric).alias(new)).crossJoin(
        metrics_old.select(F.col(metric).alias(old))
    ).withColumn("redeploy", F.coalesce(F.col(new) > F.col(old), F.lit(False)))
