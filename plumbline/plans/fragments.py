"""SQL text shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from plumbline.config import FEATURES, FeatureConfig
from plumbline.operators.experiment import MASK, MIX, POISSON_STEPS, REPLICATES, replicate_keys

WIDE_FEATURES = ["q", "d", "t", "tp", "ps", "rp", "sa", "ca"]

WIDE = """
wide AS (
  SELECT md5(concat_ws('|', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar,
             l_suppkey::varchar, cast(round(l_extendedprice * 100) AS bigint)::varchar,
             strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f'))) AS row_id,
         l_quantity AS q, l_discount AS d, l_tax AS t, o_totalprice AS tp,
         p_size::double AS ps, p_retailprice AS rp, s_acctbal AS sa, c_acctbal AS ca,
         l_extendedprice AS target, o_orderdate::date AS dt,
         1500.0::double * l_quantity + 0.01::double * o_totalprice + 200.0::double * p_size AS champ,
         (1500.0::double * l_quantity + 0.01::double * o_totalprice + 200.0::double * p_size) * 1.01::double
           + 50.0::double * c_acctbal / 100.0::double AS chall
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey),
ref AS (SELECT * FROM wide WHERE dt < DATE '1999-01-01'),
cur AS (SELECT *, strftime(date_trunc('month', dt), '%Y-%m-%d') AS month FROM wide WHERE dt >= DATE '1999-01-01')"""

VECTORS = (
    "vectors AS (SELECT vec_id::varchar AS row_id, "
    + ", ".join(f"embedding[{i + 1}]::double AS {c}" for i, c in enumerate(FEATURES))
    + ", 2.0::double * embedding[3]::double + 40.0::double * embedding[3]::double * embedding[14]::double"
    " + 40.0::double * embedding[17]::double * embedding[17]::double"
    " + 2.0::double * embedding[10]::double + embedding[41]::double AS target, label FROM embeddings)"
)


def h32(key: str, seed: str) -> str:
    return f"('0x' || substr(md5(concat({key}, ':', '{seed}')), 1, 8))::bigint"


def unit(key: str, seed: str) -> str:
    return f"({h32(key, seed)} / 4294967296.0::double)"


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name}"


def long(source: str, cols: list[str], keep: str = "") -> str:
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {keep}'{c}' AS feature, {c}::double AS value FROM {source}" for c in cols)


def psi_ctes(ref_long: str, cur_long: str, by: str, bins: int = 10, p: str = "") -> str:
    """CTEs <p>edges, <p>psi(feature, by, psi, out_of_range_pct) from two long relations."""
    probs = ",".join(str(i / bins) for i in range(bins + 1))
    return f"""
{p}rl AS ({ref_long}), {p}cl AS ({cur_long}),
{p}edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS e FROM {p}rl GROUP BY feature),
{p}tagged AS (SELECT feature, '(reference)' AS {by}, value FROM {p}rl UNION ALL SELECT feature, {by}::varchar, value FROM {p}cl),
{p}binned AS (SELECT b.feature, {by}, CASE WHEN value < e[1] - 1e-6 OR value > e[len(e)] + 1e-6 THEN NULL
    ELSE len(list_filter(e[2:len(e)-1], lambda y: y <= value)) END AS bin, value
  FROM {p}tagged b JOIN {p}edges USING (feature)),
{p}cnt AS (SELECT feature, {by}, bin, count(*) AS n FROM {p}binned WHERE bin IS NOT NULL GROUP BY ALL),
{p}side AS (SELECT feature, {by}, count(*) AS n_all, count(bin) AS n_in, avg(value) AS m, stddev_pop(value) AS s,
    stddev_samp(value) AS ss FROM {p}binned GROUP BY ALL),
{p}grid AS (SELECT s.feature, s.{by}, unnest(range(len(e) - 1)) AS bin, len(e) - 1 AS k, n_in, n_all
  FROM {p}side s JOIN {p}edges USING (feature)),
{p}pct AS (SELECT g.feature, g.{by}, g.bin, k, (coalesce(n, 0) + 1e-6) / (n_in + 1e-6 * k) AS p
  FROM {p}grid g LEFT JOIN {p}cnt c ON g.feature = c.feature AND g.{by} = c.{by} AND g.bin = c.bin),
{p}psi AS (SELECT c.feature, c.{by}, CASE WHEN max(c.k) < 2 THEN 0.0 ELSE sum((c.p - f.p) * ln(c.p / f.p)) END AS psi
  FROM {p}pct c JOIN {p}pct f ON c.feature = f.feature AND c.bin = f.bin AND f.{by} = '(reference)'
  WHERE c.{by} <> '(reference)' GROUP BY ALL)"""


def ks_ctes(by: str, p: str = "") -> str:
    """CTE <p>ks(feature, by, ks_stat, wasserstein, n, m); needs <p>rl and <p>cl."""
    return f"""
{p}rv AS (SELECT feature, value, count(*) AS n FROM {p}rl GROUP BY ALL),
{p}cv AS (SELECT feature, {by}::varchar AS {by}, value, count(*) AS n FROM {p}cl GROUP BY ALL),
{p}bk AS (SELECT DISTINCT feature, {by} FROM {p}cv),
{p}mix AS (SELECT feature, {by}, value, sum(rn) AS rn, sum(cn) AS cn FROM (
    SELECT rv.feature, bk.{by}, rv.value, rv.n AS rn, 0 AS cn FROM {p}rv rv JOIN {p}bk bk USING (feature)
    UNION ALL SELECT feature, {by}, value, 0, n FROM {p}cv) GROUP BY ALL),
{p}cum AS (SELECT feature, {by}, value,
    sum(rn) OVER w AS cr, sum(cn) OVER w AS cc,
    sum(rn) OVER (PARTITION BY feature, {by}) AS nr, sum(cn) OVER (PARTITION BY feature, {by}) AS nc,
    lead(value) OVER w AS nxt
  FROM {p}mix WINDOW w AS (PARTITION BY feature, {by} ORDER BY value)),
{p}ks AS (SELECT feature, {by}, max(abs(cr::double / nr::double - cc::double / nc::double)) AS ks_stat,
    sum(abs(cr::double / nr::double - cc::double / nc::double) * coalesce(nxt - value, 0)) AS wasserstein,
    max(nr)::double AS n, max(nc)::double AS m FROM {p}cum GROUP BY ALL)"""


def kolmogorov(d: str, n: str, m: str) -> str:
    lam = f"(sqrt({n} * {m} / ({n} + {m})) * {d})"
    small = (
        f"1.0 - sqrt(2 * pi()) / {lam} * list_sum(list_transform(range(1, 21),"
        f" lambda k: exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * {lam} * {lam}))))"
    )
    large = (
        f"2.0 * list_sum(list_transform(range(1, 21),"
        f" lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * {lam} * {lam})))"
    )
    return (
        f"CASE WHEN {lam} <= 1e-9 THEN 1.0 WHEN {lam} < 1.18 THEN {small} ELSE greatest({large}, 0.0) END"
    )


def severity(psi: str = "psi", ks: str = "ks_stat") -> str:
    return (
        f"CASE WHEN {psi} >= 0.25 OR {ks} >= 0.20 THEN 'alert'"
        f" WHEN {psi} >= 0.10 OR {ks} >= 0.10 THEN 'warning' ELSE 'ok' END"
    )


def _simpson(density: str, upper: str, steps: int = 4000) -> str:
    """Integral of ``density`` (of x) from 0 to ``upper`` by Simpson's rule."""
    at = density.replace("{x}", f"(i * {upper} / {steps})")
    return (
        f"({upper} / {steps} / 3 * list_sum(list_transform(range(0, {steps + 1}), lambda i:"
        f" (CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {at})))"
    )


def normal_p(z: str) -> str:
    """Two-sided normal p."""
    area = _simpson("exp(-{x} * {x} / 2) / sqrt(2 * pi())", f"least(abs({z}), 12.0)")
    return f"greatest(1.0 - 2.0 * {area}, 0.0)"


def student_p(t: str, df: str) -> str:
    """Two-sided Student-t p."""
    const = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    area = _simpson(f"{const} * pow(1 + {{x}} * {{x}} / {df}, -({df} + 1) / 2)", f"least(abs({t}), 40.0)")
    return f"greatest(1.0 - 2.0 * {area}, 0.0)"


def avg_rank_cte(name: str, source: str, col: str) -> str:
    """CTE with (value, n, rank) of one column."""
    return f"""
{name} AS (SELECT value, n, sum(n) OVER (ORDER BY value) - n + (n + 1) / 2.0 AS rank
  FROM (SELECT {col} AS value, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY 1))"""


def arms_ctes(source: str, value: str, arm: str = "arm") -> str:
    """CTEs mom (moments + Welch) and rk (Mann-Whitney, KS) of two arms."""
    return f"""
arms AS (SELECT row_id, {value}::double AS x, {arm} AS arm FROM {source}),
m0 AS (SELECT count(x) FILTER (arm = 0) AS n_a, count(x) FILTER (arm = 1) AS n_b,
    avg(x) FILTER (arm = 0) AS mean_a, avg(x) FILTER (arm = 1) AS mean_b,
    stddev_pop(x) FILTER (arm = 0) AS std_a, stddev_pop(x) FILTER (arm = 1) AS std_b,
    var_samp(x) FILTER (arm = 0) AS va, var_samp(x) FILTER (arm = 1) AS vb FROM arms),
mom AS (SELECT n_a, n_b, mean_a, mean_b, std_a, std_b, mean_a - mean_b AS mean_diff,
    (mean_a - mean_b) / sqrt(va / n_a + vb / n_b) AS welch_t,
    pow(va / n_a + vb / n_b, 2) / (pow(va / n_a, 2) / (n_a - 1) + pow(vb / n_b, 2) / (n_b - 1)) AS welch_df FROM m0),
vc AS (SELECT x, count(*) FILTER (arm = 0) AS na, count(*) FILTER (arm = 1) AS nb, count(*) AS k FROM arms GROUP BY x),
vw AS (SELECT *, sum(k) OVER (ORDER BY x) AS cum, sum(na) OVER (ORDER BY x) AS ca_, sum(nb) OVER (ORDER BY x) AS cb_,
    sum(na) OVER () AS ta, sum(nb) OVER () AS tb FROM vc),
rk0 AS (SELECT max(ta)::double AS n, max(tb)::double AS m,
    sum(na * (cum - k + (k + 1) / 2.0))::double AS rs, sum(k::double * k * k - k) AS ties,
    max(abs(ca_::double / ta::double - cb_::double / tb::double)) AS ks_stat FROM vw),
rk AS (SELECT *, rs - n * (n + 1) / 2 AS mw_u, (greatest(rs - n * (n + 1) / 2, n * m - (rs - n * (n + 1) / 2)) - n * m / 2 - 0.5)
    / sqrt(n * m / 12 * ((n + m + 1) - ties / ((n + m) * (n + m - 1)))) AS mw_z FROM rk0)"""


ARMS_SELECT = ", ".join([
    "n_a", "n_b", *[r(c, c) for c in ("mean_a", "mean_b", "std_a", "std_b", "mean_diff", "welch_t")],
    r("welch_df", "welch_df", 3), r(student_p("welch_t", "welch_df"), "welch_p"),
    r("mw_u", "mw_u", 1), r(normal_p("greatest(mw_z, 0.0)"), "mw_p"), r("ks_stat", "ks_stat"),
    r(kolmogorov("ks_stat", "n", "m"), "ks_p"),
])


def replicate_ctes(sums: dict[str, str], source: str, replicates: int = REPLICATES, seed: int = 42) -> str:
    """CTE reps(rep, sums): rows of ``source`` (with a row_id) resampled with Poisson(1) counts.

    The same integers as the operator's: two words of the row's md5 mixed with the replicate's number.
    """
    keys = f"[{', '.join(map(str, replicate_keys(replicates, seed)))}]"
    word = lambda at: f"('0x' || substr(md5(concat(row_id, ':boot')), {at}, 8))::UBIGINT"
    count = " + ".join(f"(u >= {s})::INT" for s in POISSON_STEPS)
    c1, c2, c3, _ = MIX
    return f"""
bk AS (SELECT unnest(range(1, {replicates + 1})) AS rep, unnest({keys})::UBIGINT AS k),
bh AS (SELECT {word(1)} AS h1, {word(9)} AS h2, {', '.join(f'({e})::DOUBLE AS {n}' for n, e in sums.items())} FROM {source}),
b1 AS (SELECT rep, h2, {', '.join(sums)}, (xor(h1, k) * {c1}) & {MASK} AS u FROM bh, bk),
b2 AS (SELECT * REPLACE ((((xor(u, u >> 15) + h2) & {MASK}) * {c2}) & {MASK} AS u) FROM b1),
b3 AS (SELECT * REPLACE ((xor(u, u >> 13) * {c3}) & {MASK} AS u) FROM b2),
b4 AS (SELECT * REPLACE (xor(u, u >> 16) AS u) FROM b3),
b5 AS (SELECT *, {count} AS w FROM b4),
reps AS (SELECT rep, {', '.join(f'sum(w * {n}) AS {n}' for n in sums)} FROM b5 WHERE w > 0 GROUP BY rep)"""


def fe_sql(cfg: FeatureConfig = FeatureConfig()) -> dict[str, list[str]]:
    """SQL columns of each engineered family."""
    unary, pairs = [], []
    for f in cfg.unary:
        unary += [
            r(f"ln(1 + abs({f}))", f"{f}_log"), r(f"sqrt(abs({f}))", f"{f}_sqrt"), r(f"{f} * {f}", f"{f}_sq"),
        ]
    for i, a in enumerate(cfg.pairs):
        for b in cfg.pairs[i + 1:]:
            pairs += [r(f"{a} * {b}", f"{a}_x_{b}"), r(f"{a} / (abs({b}) + 1e-6)", f"{a}_div_{b}")]
    every = "[" + ", ".join(cfg.base) + "]"
    stats = [
        r(f"list_avg({every})", "row_mean"), r(f"list_stddev_samp({every})", "row_std"),
        r(f"list_max({every})", "row_max"), r(f"list_min({every})", "row_min"),
        r(f"list_max({every}) - list_min({every})", "row_range"),
    ]
    weighted = r(" + ".join(f"{w}::double * {f}" for f, w in cfg.weights.items()), "weighted_top")
    return {"unary": unary, "pairs": pairs, "stats": stats, "weighted": [weighted]}


def planted_ctes() -> str:
    """CTE planted: the current side in four slices with growing planted drift."""
    return f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY dt, row_id) - 1 AS idx, count(*) OVER () // 4 AS size FROM cur),
sliced AS (SELECT *, cast(idx // size + 1 AS int) AS batch FROM numbered WHERE idx < 4 * size),
sg AS (SELECT stddev_pop(q) AS sq FROM ref),
bm AS (SELECT batch, avg(tp) AS mtp FROM sliced GROUP BY batch),
planted0 AS (SELECT s.* REPLACE (
    CASE batch WHEN 2 THEN q + 0.5::double * sq WHEN 3 THEN q + 1.0::double * sq WHEN 4 THEN q + 2.0::double * sq ELSE q END AS q,
    CASE batch WHEN 3 THEN mtp + (tp - mtp) * 1.5::double WHEN 4 THEN mtp + (tp - mtp) * 2.0::double ELSE tp END AS tp)
  FROM sliced s JOIN bm USING (batch) CROSS JOIN sg),
planted AS (SELECT * REPLACE (CASE batch WHEN 4 THEN ps + 0.3::double * q ELSE ps END AS ps),
    1500.0::double * q + 0.01::double * tp + 200.0::double * CASE batch WHEN 4 THEN ps + 0.3::double * q ELSE ps END AS pred
  FROM planted0)"""


def history_ctes() -> str:
    """CTEs rec (drift records of the planted batches) and hist (monitoring rows)."""
    feats = psi_ctes(long("ref", WIDE_FEATURES), long("planted", WIDE_FEATURES, "batch"), "batch")
    preds = psi_ctes(long("(SELECT champ AS prediction FROM ref)", ["prediction"]),
                     long("(SELECT batch, pred AS prediction FROM planted)", ["prediction"], "batch"), "batch", p="p_")
    return f"""{WIDE}, {planted_ctes()}, {feats}, {ks_ctes("batch")}, {preds}, {ks_ctes("batch", "p_")},
rec AS (SELECT psi.feature, psi.batch, psi, ks_stat, {severity()} AS severity FROM psi JOIN ks USING (feature, batch)),
prec AS (SELECT p_psi.batch, psi, ks_stat, {severity()} AS severity FROM p_psi JOIN p_ks USING (feature, batch)),
fsum AS (SELECT batch, max(psi) AS feature_psi_max, avg(psi) AS feature_psi_mean,
    count(*) FILTER (severity = 'alert') AS feature_n_alerts, count(*) FILTER (severity = 'warning') AS feature_n_warnings
  FROM rec GROUP BY batch),
nrow AS (SELECT batch::varchar AS batch, count(*) AS n_rows, avg(pred) AS prediction_mean FROM planted GROUP BY 1),
hist AS (SELECT f.*, n_rows, prec.psi AS prediction_psi, prec.ks_stat AS prediction_ks, prediction_mean,
    CASE WHEN prec.severity = 'alert' OR feature_n_alerts > 2 THEN 'alert'
         WHEN prec.severity = 'warning' OR feature_n_warnings > 3 THEN 'warning' ELSE 'ok' END AS severity
  FROM fsum f JOIN nrow USING (batch) JOIN prec USING (batch))"""
