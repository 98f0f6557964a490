"""Planted drift for back-tests of the monitor."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.longform import finite_sql


@dataclass(frozen=True)
class Plant:
    """Changes to one batch: shift by k reference sigmas, spread about the batch mean,
    then mix columns (x += weight * source, on the already shifted source)."""

    shift: dict[str, float] = field(default_factory=dict)
    spread: dict[str, float] = field(default_factory=dict)
    mix: dict[str, tuple[str, float]] = field(default_factory=dict)


def day_plan(first: str, second: str, third: str) -> dict[int, Plant]:
    """Four days of growing drift in up to three columns."""
    return {
        1: Plant(),
        2: Plant({first: 0.5}),
        3: Plant({first: 1.0}, {second: 1.5}),
        4: Plant({first: 2.0}, {second: 2.0}, {third: (first, 0.3)}),
    }


def perturb(df: DataFrame, reference: DataFrame, batch: str, plan: dict[int, Plant]) -> DataFrame:
    """Apply the plan of each batch. Sigmas and batch means are a handful of numbers."""
    shifted = sorted({c for p in plan.values() for c in p.shift})
    spread = sorted({c for p in plan.values() for c in p.spread})
    mixed = sorted({c for p in plan.values() for c in p.mix})
    sigma = reference.agg(*[F.expr(f"stddev_pop({finite_sql(c)}) as `{c}`") for c in shifted]).first() if shifted else {}
    means = {}
    if spread:
        wanted = [b for b, p in plan.items() if p.spread]
        rows = df.where(F.col(batch).isin(wanted)).groupBy(batch).agg(
            *[F.expr(f"avg({finite_sql(c)}) as `{c}`") for c in spread]
        )
        means = {r[batch]: r for r in rows.collect()}

    def cases(c, parts):
        whens = " ".join(f"when `{batch}` = {b} then {e}" for b, e in parts)
        return F.expr(f"case {whens} else `{c}` end") if whens else F.col(c)

    out = df.withColumns({
        c: cases(c, [(b, f"`{c}` + {p.shift[c] * sigma[c]!r}D") for b, p in plan.items() if c in p.shift])
        for c in shifted
    })
    out = out.withColumns({
        c: cases(c, [
            (b, f"{means[b][c]!r}D + (`{c}` - {means[b][c]!r}D) * {p.spread[c]!r}D")
            for b, p in plan.items() if c in p.spread and b in means
        ])
        for c in spread
    })
    return out.withColumns({
        c: cases(c, [(b, f"`{c}` + {p.mix[c][1]!r}D * `{p.mix[c][0]}`") for b, p in plan.items() if c in p.mix])
        for c in mixed
    })
