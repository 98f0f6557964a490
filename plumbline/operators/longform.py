"""Wide rows to one record per feature, so that many features share one job.

Expressions here are SQL text: one text of many columns is one call to the JVM,
where a tree of Column objects is thousands.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_sql(name: str) -> str:
    return f"nanvl(cast(`{name}` as double), cast(null as double))"


def finite(name: str) -> Column:
    """The column as double with NaN turned into null."""
    return F.expr(finite_sql(name))


def corr_sql(x: str, y: str) -> str:
    """Pearson correlation of two SQL values that are missing together; null when one
    is constant, where the built-in function divides by zero."""
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0.0D)"


def number_array(values: Sequence[float | int]) -> str:
    """SQL text of an array of numbers."""
    return "array(" + ",".join(f"{v!r}D" if isinstance(v, float) else str(v) for v in values) + ")"


def to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(ids..., feature, value); nulls and NaN are left out."""
    wide = df.selectExpr(*[f"`{c}`" for c in ids], *[f"{finite_sql(c)} as `{c}`" for c in features])
    return wide.unpivot(list(ids), list(features), "feature", "value").where("value is not null")


def stack(df: DataFrame, keep: Sequence[str], records: Sequence[dict[str, str]]) -> DataFrame:
    """One output row per record (named SQL expressions) for every input row."""
    names = list(records[0])
    structs = ",".join(
        "named_struct(" + ",".join(f"'{k}', {r[k]}" for k in names) + ")" for r in records
    )
    return df.selectExpr(*[f"`{c}`" for c in keep], f"inline(array({structs}))")


def feature_columns(df: DataFrame, target: str | None = None, prefix: str | None = None) -> list[str]:
    names = [c for c in df.columns if c != target]
    return [c for c in names if c.startswith(prefix)] if prefix else names


def with_buckets(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Adds ``<column>__bucket`` (int): the number of cuts at or below the value.

    A binary search per value on the JVM, whatever the number of cuts; long chains
    of comparisons would outgrow generated code.
    """
    split = [c for c in cuts if cuts[c]]
    if split:
        df = Bucketizer(
            inputCols=split,
            outputCols=[f"{c}__raw" for c in split],
            splitsArray=[[-math.inf, *cuts[c], math.inf] for c in split],
            handleInvalid="keep",
        ).transform(df)
    kept = [f"`{c}`" for c in df.columns if not c.endswith("__raw")]
    new = [
        f"cast(`{c}__raw` as int) as `{c}__bucket`" if cuts[c] else f"0 as `{c}__bucket`" for c in cuts
    ]
    return df.selectExpr(*kept, *new)
