"""Exact quantiles without a global sort.

A mergeable sketch brackets every wanted rank; one more pass counts what lies
outside the brackets and keeps the values inside. Only bracketed values are
shuffled, so a quantile over N rows costs two scans and a shuffle of under one
percent of the values. Brackets that would still hold too many rows are narrowed
with another sketch first. The answer does not depend on the sketch: a rank that
falls outside its bracket is detected and searched again in a wider one.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.longform import number_array, stack, with_buckets

SKETCH_K = 4096
MERGE_GROUPS = 256


def sketch(
    df: DataFrame, values: dict[str, str], probs: dict[str, Sequence[float]], k: int = SKETCH_K
) -> dict[str, tuple[int, list[float]]]:
    """Row count and approximate quantiles per named SQL value, merged as a two-level tree."""
    names = list(values)
    rows = df.selectExpr(*[f"{values[c]} as `{c}`" for c in names])
    part = rows.groupBy(F.expr(f"spark_partition_id() % {MERGE_GROUPS}").alias("_g")).agg(
        *[F.expr(f"kll_sketch_agg_double(`{c}`, {k}) as `{c}`") for c in names]
    )
    merged = part.agg(*[F.expr(f"kll_merge_agg_double(`{c}`, {k}) as `{c}`") for c in names])
    row = merged.selectExpr(
        *[
            f"named_struct('n', coalesce(kll_sketch_get_n_double(`{c}`), 0), 'q', "
            f"if(kll_sketch_get_n_double(`{c}`) > 0, "
            f"kll_sketch_get_quantile_double(`{c}`, {number_array([float(p) for p in probs[c]])}), null)) as `{c}`"
            for c in names
        ]
    ).first()
    return {c: (row[c]["n"], list(row[c]["q"] or [])) for c in names}


def _merged(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _ranks(n: int, probs: Sequence[float]) -> list[int]:
    wanted = set()
    for p in probs:
        r = p * (n - 1)
        wanted |= {math.floor(r), math.ceil(r)}
    return sorted(wanted)


def _number(x: float) -> str:
    return f"cast('{x!r}' as double)"


def _narrow(df, values, brackets, sizes, ranks, max_rows):
    """Sketch inside every bracket above ``max_rows`` and shrink it around its ranks."""
    slack = 0.02
    while True:
        wide = {
            f"{c}#{i}": (c, i) for c in brackets for i, size in enumerate(sizes[c])
            if size > max_rows and brackets[c][i][0] < brackets[c][i][1]
        }
        if not wide:
            return brackets
        inside, below = {}, []
        for key, (c, i) in wide.items():
            lo, hi = (_number(x) for x in brackets[c][i])
            inside[key] = f"if({values[c]} between {lo} and {hi}, {values[c]}, null)"
            below += [
                f"count_if({values[c]} < {lo}) as `{key}#below`",
                f"count_if({values[c]} between {lo} and {hi}) as `{key}#inside`",
            ]
        seen = df.agg(*[F.expr(e) for e in below]).first().asDict()
        asked = {}
        for key, (c, i) in wide.items():
            m = seen[f"{key}#inside"]
            mine = [r - seen[f"{key}#below"] for r in ranks[c]]
            mine = [r for r in mine if 0 <= r < m] or [0, m]
            asked[key] = [max(0.0, min(mine) / m - slack), min(1.0, max(mine) / m + slack)]
        cut = sketch(df, inside, asked, 1024)
        progress = False
        for key, (c, i) in wide.items():
            m, q = cut[key]
            lo, hi = brackets[c][i]
            new = (lo if asked[key][0] == 0.0 else q[0], hi if asked[key][1] == 1.0 else q[1])
            progress |= new != (lo, hi)
            brackets[c][i] = new
            sizes[c][i] = int(m * (asked[key][1] - asked[key][0]))
        if not progress:
            return brackets


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str] | dict[str, str],
    probs: Sequence[float],
    max_rows: int = 2_000_000,
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per column: {name: [one value per prob]}.

    Only (columns x probs) numbers reach the driver. Columns without a value get
    an empty list. ``columns`` may also map names to SQL text, e.g. one value per group.
    """
    if not isinstance(columns, dict):
        columns = {c: f"`{c}`" for c in columns}
    df = df.selectExpr(
        *[f"nanvl(cast({e} as double), cast(null as double)) as `{c}`" for c, e in columns.items()]
    )
    values = {c: f"`{c}`" for c in columns}
    answer: dict[str, list[float]] = {}
    todo, slack = list(values), 0.003
    while todo:
        asked = {}
        for c in todo:
            asked[c] = [x for p in probs for x in (max(0.0, p - slack), min(1.0, p + slack))]
        got = sketch(df, {c: values[c] for c in todo}, asked)
        n = {c: got[c][0] for c in todo}
        answer |= {c: [] for c in todo if n[c] == 0}
        todo = [c for c in todo if n[c] > 0]
        if not todo:
            break
        ranks = {c: _ranks(n[c], probs) for c in todo}
        brackets, sizes = {}, {}
        for c in todo:
            q = got[c][1]
            edges = [
                (
                    -math.inf if asked[c][2 * i] == 0.0 else q[2 * i],
                    math.inf if asked[c][2 * i + 1] == 1.0 else q[2 * i + 1],
                )
                for i in range(len(probs))
            ]
            brackets[c] = _merged(edges)
            sizes[c] = [int(2 * slack * n[c] * len(probs) / len(brackets[c]))] * len(brackets[c])
        brackets = _narrow(df, values, brackets, sizes, ranks, max_rows)
        found = _pick(df, values, brackets, ranks)
        again = []
        for c in todo:
            if any(r not in found.get(c, {}) for r in ranks[c]):
                again.append(c)
                continue
            answer[c] = []
            for p in probs:
                r = p * (n[c] - 1)
                low, high = found[c][math.floor(r)], found[c][math.ceil(r)]
                answer[c].append(low + (high - low) * (r - math.floor(r)))
        if again and slack >= 1.0:
            raise ValueError(f"infinite values in {again}")
        todo, slack = again, min(1.0, slack * 8)
    return answer


def _pick(df, values, brackets, ranks) -> dict[str, dict[int, float]]:
    """Values at the wanted ranks. Values outside all brackets collapse to one row per gap."""
    lowest, highest = -sys.float_info.max, sys.float_info.max
    cuts = {}
    for c, spans in brackets.items():
        # odd segments are brackets, even ones the gaps around them
        cuts[c] = sorted({
            x for lo, hi in _merged(spans)
            for x in (max(lo, lowest), math.nextafter(min(hi, math.nextafter(highest, 0)), math.inf))
        })
    wide = with_buckets(df.selectExpr(*[f"{values[c]} as `{c}`" for c in cuts]), cuts)
    cells = (
        stack(wide, [], [{"name": f"'{c}'", "seg": f"`{c}__bucket`", "v": f"`{c}`"} for c in cuts])
        .where("v is not null")
        .groupBy("name", "seg", F.expr("if(seg % 2 = 1, v, null)").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    # at most max_rows values per bracket by construction, so one task per column is bounded
    wanted = "map(" + ",".join(f"'{c}',{number_array(r)}" for c, r in ranks.items()) + ")"
    hits = cells.selectExpr(
        "name", "v", "n", "sum(n) over (partition by name order by seg, v) as upto"
    ).selectExpr(
        "name", "v",
        f"explode(filter({wanted}[name], r -> r < upto and r >= upto - n)) as rank",
    ).where("v is not null")
    out: dict[str, dict[int, float]] = {}
    for row in hits.collect():
        out.setdefault(row["name"], {})[row["rank"]] = row["v"]
    return out
