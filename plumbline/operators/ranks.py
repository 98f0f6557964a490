"""Ordered statistics over row-sized data: running counts, ranks, as-of lookups.

The value axis of every feature is cut into buckets of about equal row counts, so
a running sum is a window inside a bucket plus a small table of bucket offsets.
Equal values are folded into one counted row before the shuffle, so a value that
holds a third of all rows is still one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.longform import finite_sql, stack, with_buckets
from plumbline.operators.quantiles import sketch
from plumbline.session import stage

ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 4096


def cut_points(
    df: DataFrame, cols: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> dict[str, list[float]]:
    """Cuts that split each column into buckets of about ``rows_per_bucket`` rows.

    They steer the balance only; every result is the same for any cuts.
    """
    values = {c: finite_sql(c) for c in cols}
    grid = [i / 256 for i in range(1, 256)]
    got = sketch(df, values, {c: grid for c in cols}, 4096)
    cuts = {}
    for c in cols:
        n, q = got[c]
        want = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket))
        if want <= 1:
            cuts[c] = []
        elif want <= 256:
            cuts[c] = sorted({q[round(i * 256 / want) - 1] for i in range(1, want)})
        else:
            cuts[c] = None
    fine = [c for c in cols if cuts[c] is None]
    if fine:
        want = {c: min(MAX_BUCKETS, math.ceil(got[c][0] / rows_per_bucket)) for c in fine}
        probs = {c: [i / want[c] for i in range(1, want[c])] for c in fine}
        again = sketch(df, {c: values[c] for c in fine}, probs, 32768)
        cuts |= {c: sorted(set(again[c][1])) for c in fine}
    return cuts


def value_counts(
    df: DataFrame,
    cols: Sequence[str],
    sums: dict[str, str] | None = None,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(feature, bucket, by..., value, sums...): one row per distinct value.

    Bucket numbers rise with the value inside a feature and are never shared by two.

    ``sums`` maps a name to SQL text to add up per value; the default counts rows.
    """
    sums = sums or {"n": "1"}
    wide = df.selectExpr(
        *by, *[f"{finite_sql(c)} as `{c}`" for c in cols], *[f"{e} as `_{k}`" for k, e in sums.items()]
    )
    wide = with_buckets(wide, cut_points(wide, cols, rows_per_bucket))
    # adding zero makes -0.0 and 0.0 one value
    long = stack(
        wide,
        [*by, *[f"_{k}" for k in sums]],
        [
            {"bucket": f"`{c}__bucket` + {i * (MAX_BUCKETS + 1)}", "value": f"`{c}` + 0.0D"}
            for i, c in enumerate(cols)
        ],
    ).where("value is not null")
    # the bucket number implies the feature, so the name need not travel with every row
    names = ",".join(f"'{c}'" for c in cols)
    counts = long.groupBy("bucket", *by, "value").agg(
        *[F.expr(f"sum(`_{k}`) as `{k}`") for k in sums]
    ).selectExpr(
        f"array({names})[bucket div {MAX_BUCKETS + 1}] as feature", "bucket", *by, "value", *sums
    )
    # read several times below (rows, bucket totals), each time with other columns
    return stage(counts, "counts")


def running_sums(
    counts: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = ("feature",),
    base: DataFrame | None = None,
) -> DataFrame:
    """Adds ``cum_x`` (values up to and including this one) and ``tot_x`` per ``keys``.

    Offsets come from a table of (keys x buckets) rows; the bucketed rows
    themselves are only ever sorted inside their bucket. The offsets are written
    out, so the planner sees their true size and broadcasts them only if small.
    ``base`` names a cheaper frame with the same rows to total up.
    """
    keys = list(keys)
    group = ", ".join(keys)
    totals = (base or counts).groupBy(*keys, "bucket").agg(*[F.expr(f"sum({x}) as {x}") for x in names])
    before = f"over (partition by {group} order by bucket rows between unbounded preceding and 1 preceding)"
    offsets = totals.selectExpr(
        *keys, "bucket",
        *[f"coalesce(sum({x}) {before}, 0) as _off_{x}" for x in names],
        *[f"sum({x}) over (partition by {group}) as tot_{x}" for x in names],
    )
    other = [k for k in keys if k != "feature"]
    rest = ", ".join(["bucket", *other])
    local = counts.selectExpr(
        "*", *[f"sum({x}) over (partition by {rest} order by value) as _cum_{x}" for x in names]
    )
    kept = [c for c in counts.columns]
    offsets = stage(offsets.drop("feature"), "offsets")
    return local.join(offsets, ["bucket", *other]).selectExpr(
        *kept, *[e for x in names for e in (f"_cum_{x} + _off_{x} as cum_{x}", f"tot_{x}")]
    )


def average_ranks(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """(feature, value, n, avg_rank, tot_n): 1-based ranks, ties get their mean."""
    ranked = running_sums(value_counts(df, cols, **kw), ["n"])
    return ranked.selectExpr("feature", "value", "n", "cum_n - n + (n + 1) / 2.0D as avg_rank", "tot_n")


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str,
    total: str,
    salts: int = 64,
) -> DataFrame:
    """Join per-value facts back to rows without letting a hot value pile up.

    A value holding more than 1/salts of its group's rows is hot; there are fewer
    than ``salts`` of them per group, so the hot list is small whatever the data
    size. Their rows are spread over ``salts`` join keys.
    """
    on = list(on)
    is_hot = F.col(weight) * salts > F.col(total)
    hot = table.where(is_hot).select(*on, F.lit(True).alias("_hot"))
    rest = [c for c in rows.columns if c not in on] or on
    spread = F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int")
    keyed = (
        rows.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(0))
        .drop("_hot")
    )
    copies = F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(0))
    facts = table.withColumn("_salt", F.explode(copies)).drop(weight, total)
    return keyed.join(facts, [*on, "_salt"]).drop("_salt")
