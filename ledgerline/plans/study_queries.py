"""Queries of studies with many regressors and sorts, of the whole battery, and of report, emission and registry tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.dates import add_months, months_between
from ledgerline.functions.frames import by
from ledgerline.functions.tables import written
from ledgerline.operators import emissions as em
from ledgerline.operators import checks as q
from ledgerline.operators import filters as fl
from ledgerline.operators import pit
from ledgerline.operators import statistics as st
from ledgerline.operators import universe as u
from ledgerline.plans.check_queries import LONG_SQL, panel
from ledgerline.plans.pit_queries import EM_SQL, ITEMS, WIDE_SQL, annual_wide, clean, dated, emission_panel, emission_snapshots
from ledgerline.plans.registry import query
from ledgerline.plans.universe_queries import monthly, universe
from ledgerline.sources import imports as im
from ledgerline.sources.proxy import PANEL_SQL, daily_panel, daily_sums, delistings, last_days, read, statics


def _r(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def elimination(source: str, out: str, keep: str, k: int, cell=lambda i, j: f"c{i}_{j}") -> str:
    """SQL of the tables that solve k symmetric equations in each row of `source` (cells `cell(i, j)`, right sides
    `cell(i, k)`), as b0, b1, ... of table `out`."""
    a = lambda i, j: f"s{i}_{j}"
    cells = [(i, j) for i in range(k) for j in range(i, k + 1)]
    first = ", ".join([f"{cell(i, j)} AS {a(i, j)}" for i, j in cells] + [f"{cell(i, i)} AS d{i}" for i in range(k)])
    steps = [f"{out}_0 AS (SELECT {keep}, {first} FROM {source})"]
    for p in range(k):
        pivot = f"CASE WHEN {a(p, p)} > 1e-10 * d{p} THEN {a(p, p)} END"
        row = [f"{pivot} AS {a(i, j)}" if i == j == p else f"{a(i, j)} - {a(p, i)} * {a(p, j)} / ({pivot}) AS {a(i, j)}" if i > p else a(i, j) for i, j in cells]
        steps.append(f"{out}_{p + 1} AS (SELECT {keep}, {', '.join(row)}, {', '.join(f'd{i}' for i in range(k))} FROM {out}_{p})")
    back = [f"({a(i, k)}{''.join(f' - {a(i, j)} * b{j}' for j in range(i + 1, k))}) / {a(i, i)} AS b{i}" for i in reversed(range(k))]
    steps.append(f"{out} AS (SELECT {keep}, {', '.join(back)} FROM {out}_{k})")
    return ", ".join(steps)


# Regressions of months on many characteristics.

XS = ["log_me", "log_bm", "mom_12_2", "str_1", "op", "ag"]

CHAR_SQL = WIDE_SQL + """, prv AS (SELECT s.stock, s.report_month, p.assets AS assets_prev FROM snaps s ASOF LEFT JOIN snaps p ON s.stock = p.stock AND last_day(s.report_month - INTERVAL 9 MONTH) >= p.report_month),
chr AS (SELECT a.stock, a.month, ret, market_cap, equity, CASE WHEN date_diff('month', a.month, lead(a.month) OVER w) = 1 THEN lead(ret) OVER w END AS ret_next, ret AS str_1, CASE WHEN count(ret) OVER m = 11 THEN exp(sum(ln(1 + ret)) OVER m) - 1 END AS mom_12_2,
  CASE WHEN market_cap > 0 THEN ln(market_cap) END AS log_me, CASE WHEN equity > 0 AND market_cap > 0 THEN ln(equity / market_cap) END AS log_bm, (sales - coalesce(assets * 0.05, 0)) / CASE WHEN equity > 0 THEN equity END AS op,
  assets / CASE WHEN assets_prev > 0 THEN assets_prev END - 1 AS ag, equity * 0.1 / nullif(market_cap, 0) AS ep
  FROM att a LEFT JOIN prv ON prv.stock = a.stock AND prv.report_month = a.report_month WINDOW w AS (PARTITION BY a.stock ORDER BY a.month), m AS (PARTITION BY a.stock ORDER BY a.month ROWS BETWEEN 11 PRECEDING AND 1 PRECEDING))
"""


def characteristics(spark, sf_dir):
    snaps = pit.availability(pit.add_previous(dated(spark, sf_dir), ["assets"]))
    d = pit.attach(monthly(spark, sf_dir).select("stock", "month", "market_cap", "ret"), snaps, [*ITEMS, "assets_prev"])
    return st.characteristics(d.withColumns({"operating_income": F.col("sales"), "interest": F.col("assets") * 0.05, "net_income": F.col("equity") * 0.1}))


@query("der5_profitability", f"{CHAR_SQL} SELECT stock, month, round(op, 7) AS op, round(ag, 7) AS ag, round(ep, 7) AS ep FROM chr")
def der5(spark, sf_dir):
    """Profitability, asset growth and earnings yield beside the characteristics of prices."""
    return _r(characteristics(spark, sf_dir), 7, "op", "ag", "ep").select("stock", "month", "op", "ag", "ep")


def _moments(xs, y):
    names = [*xs, y]
    k = len(xs)
    return ", ".join([f"avg({c}) AS m{i}" for i, c in enumerate(names)] + [f"covar_samp({names[i]}, {names[j]}) AS c{i}_{j}" for i in range(k + 1) for j in range(i, k + 1)])


def _ols_sql(source, xs, y, least, out):
    k = len(xs)
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*xs, y])
    keep = ", ".join(["month", "n", *[f"m{i}" for i in range(k + 1)], *[f"c{i}_{k}" for i in range(k + 1)]])
    const = " ".join(f"- b{i} * m{i}" for i in range(k))
    fit = " + ".join(f"b{i} * c{i}_{k}" for i in range(k))
    return f"""mo AS (SELECT month, count(*) AS n, {_moments(xs, y)} FROM {source} WHERE {known} GROUP BY 1 HAVING count(*) >= {least}), {elimination("mo", "so", keep, k)},
 {out} AS (SELECT month, n, m{k} {const} AS const, {", ".join(f"b{i} AS {x}" for i, x in enumerate(xs))}, ({fit}) / nullif(c{k}_{k}, 0) AS r2 FROM so)"""


@query("stat1_many_regressors", f"{CHAR_SQL}, {_ols_sql('chr', XS, 'ret_next', 30, 'co')} SELECT month, n, {', '.join(f'round({c}, 6) AS {c}' for c in ['const', *XS, 'r2'])} FROM co")
def stat1(spark, sf_dir):
    """Monthly regressions of the next return on six characteristics."""
    return _r(st.grouped_ols(characteristics(spark, sf_dir), "ret_next", XS, "month", 30), 6, "const", *XS, "r2")


_CUT = ", ".join(f"quantile_cont({x}, 0.05) AS lo_{x}, quantile_cont({x}, 0.95) AS hi_{x}" for x in XS)
_WIN = ", ".join(f"least(greatest({x}, lo_{x}), hi_{x}) AS {x}" for x in XS)
_STD = ", ".join(f"({x} - avg({x}) OVER w) / nullif(stddev_samp({x}) OVER w, 0) AS {x}" for x in XS)
_UNP = " UNION ALL ".join(f"SELECT '{x}' AS series, month AS ord, {x} AS v FROM co" for x in ["const", *XS])
FM_SQL = f"""{CHAR_SQL}, kn AS (SELECT month, ret_next, {", ".join(XS)} FROM chr WHERE {" AND ".join(f"{x} IS NOT NULL" for x in [*XS, "ret_next"])} AND month >= DATE '1993-06-30' AND month <= DATE '1997-12-31'),
 cu AS (SELECT month, {_CUT} FROM kn GROUP BY 1), wi AS (SELECT kn.month, ret_next, {_WIN} FROM kn JOIN cu USING (month)), sd AS (SELECT month, ret_next, {_STD} FROM wi WINDOW w AS (PARTITION BY month)), {_ols_sql("sd", XS, "ret_next", 30, "co")}"""


def long_run_sql(lags: int) -> str:
    """SQL of mean, Newey-West error and t by series, of a table src (series, ord, v)."""
    lagged = ", ".join(f"u * lag(u, {k}) OVER w AS s{k}" for k in range(1, lags + 1))
    total = " + ".join(f"{2 * (1 - k / (lags + 1))!r} * coalesce(sum(s{k}), 0)" for k in range(1, lags + 1))
    return f"""u AS (SELECT series, ord, v, v - avg(v) OVER (PARTITION BY series) AS u FROM src WHERE v IS NOT NULL), l AS (SELECT series, v, u * u AS s0, {lagged} FROM u WINDOW w AS (PARTITION BY series ORDER BY ord)),
 h AS (SELECT series, count(*) AS n, avg(v) AS mean, sqrt(greatest(sum(s0) + {total}, 0)) / count(*) AS se FROM l GROUP BY 1) SELECT series, n, round(mean, 6) AS mean, round(se, 6) AS se, round(mean / nullif(se, 0), 3) AS t FROM h"""


@query("ap2_many_regressors", f"{FM_SQL}, src AS ({_UNP}), {long_run_sql(6)}")
def ap2(spark, sf_dir):
    """Mean coefficients on six winsorized and standardized characteristics within two dates."""
    summary, _ = st.fama_macbeth(characteristics(spark, sf_dir), XS, least=30, winsor=0.05, start="1993-06-30", end="1997-12-31")
    return _r(_r(summary, 6, "mean", "se"), 3, "t")


@query("ap2_monthly_coefficients", f"{FM_SQL} SELECT month, n, {', '.join(f'round({c}, 6) AS {c}' for c in ['const', *XS, 'r2'])} FROM co")
def ap2_monthly(spark, sf_dir):
    _, coefs = st.fama_macbeth(characteristics(spark, sf_dir), XS, least=30, winsor=0.05, start="1993-06-30", end="1997-12-31")
    return _r(coefs, 6, "const", *XS, "r2")


# Regressions of return series on factors.

FX = ["mkt", "tilt", "mkt_before"]
_SERIES_SQL = """g AS (SELECT month, region, sum(ret * cap_lag) / sum(cap_lag) AS v FROM mon JOIN statics USING (stock) WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2),
 f0 AS (SELECT month, sum(ret * cap_lag) / sum(cap_lag) AS mkt, avg(ret) AS ew FROM mon WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1), f AS (SELECT month, mkt, ew - mkt AS tilt, lag(mkt) OVER (ORDER BY month) AS mkt_before FROM f0),
 d AS (SELECT region, month, v, mkt, tilt, mkt_before, 1.0 AS const FROM g JOIN f USING (month) WHERE mkt_before IS NOT NULL)"""


def _hac_sql(lags):
    names = ["const", *FX]
    k = len(names)
    every = [*names, "v"]
    sums = ", ".join(f"CAST(sum({every[i]} * {every[j]}) AS DOUBLE) AS c{i}_{j}" for i in range(k) for j in range(i, k + 1))
    tables = [f"mo AS (SELECT region, count(*) AS n, {sums} FROM d GROUP BY 1)", elimination("mo", "be", "region, n", k)]
    joins, own, picks = [], [], []
    for v in range(k):
        rest = [i for i in range(k) if i != v]
        tables.append(elimination("mo", f"g{v}", "region", k - 1, lambda i, j, rest=rest, v=v: "c{}_{}".format(*sorted((rest[i], rest[j] if j < k - 1 else v)))))
        joins.append(f"JOIN g{v} USING (region)")
        own.append(f"{names[v]} {' '.join(f'- g{v}.b{at} * {names[i]}' for at, i in enumerate(rest))} AS x{v}")
        picks.append(f"SELECT region, '{names[v]}' AS variable, month, n, b{v} AS coef, e * x{v} AS u, x{v} * x{v} AS q FROM re")
    tables.append(f"re AS (SELECT region, month, n, {', '.join(f'be.b{i} AS b{i}' for i in range(k))}, v {' '.join(f'- be.b{i} * {names[i]}' for i in range(k))} AS e, {', '.join(own)} FROM d JOIN be USING (region) {' '.join(joins)})")
    lagged = ", ".join(f"u * lag(u, {j}) OVER w AS s{j}" for j in range(1, lags + 1))
    total = " + ".join(["sum(u * u)"] + [f"{2 * (1 - j / (lags + 1))!r} * coalesce(sum(s{j}), 0)" for j in range(1, lags + 1)])
    tables += [f"al AS ({' UNION ALL '.join(picks)})", f"la AS (SELECT *, {lagged} FROM al WINDOW w AS (PARTITION BY region, variable ORDER BY month))"]
    return f"{', '.join(tables)}, hh AS (SELECT region, variable, any_value(n) AS n, any_value(coef) AS coef, sqrt(greatest({total}, 0)) / nullif(sum(q), 0) AS se FROM la GROUP BY 1, 2)"


def _factor_series(spark, sf_dir):
    m = monthly(spark, sf_dir)
    g = u.portfolios(m.join(statics(spark, sf_dir).select("stock", "region"), "stock"), "month", "region").select("month", "region", F.col("vw").alias("v"))
    f = u.portfolios(m).select("month", F.col("vw").alias("mkt"), (F.col("ew") - F.col("vw")).alias("tilt"), F.lit(1).alias("_one"))
    return g.join(f.withColumn("mkt_before", F.lag("mkt").over(by("_one", order="month"))).drop("_one"), "month")


@query("pf8_factors_long_run_errors", f"{PANEL_SQL}, {_SERIES_SQL}, {_hac_sql(4)} SELECT region, variable, n, round(coef, 6) AS coef, round(se, 6) AS se, round(coef / nullif(se, 0), 3) AS t FROM hh")
def pf8(spark, sf_dir):
    """Each region's return on three factors, with Newey-West errors."""
    return _r(_r(st.hac_ols(_factor_series(spark, sf_dir), "v", FX, "region", "month", 4), 6, "coef", "se"), 3, "t")


# The thresholds of the summary flags. A pair is a range, a single value the least.
THRESHOLDS = {"monthly_corr": 0.99, "monthly_r2": 0.98, "monthly_beta": (0.95, 1.05), "monthly_alpha_abs_t": (0.0, 2.0), "monthly_te_annual": (0.0, 0.02), "daily_corr": 0.98, "max_weight": (0.0, 0.10)}


@query("pf16_all_flags", f"""{PANEL_SQL}, f0 AS (SELECT month, sum(ret * cap_lag) / sum(cap_lag) AS vw, avg(ret) AS ew, max(cap_lag) / sum(cap_lag) AS w FROM mon WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1),
 z AS (SELECT *, vw - regr_slope(vw, ew) OVER () * ew - regr_intercept(vw, ew) OVER () AS e, 1 - ew * sum(ew) OVER () / sum(ew * ew) OVER () AS x FROM f0), zl AS (SELECT *, e * x * lag(e * x, 1) OVER o AS l1, e * x * lag(e * x, 2) OVER o AS l2, e * x * lag(e * x, 3) OVER o AS l3 FROM z WINDOW o AS (ORDER BY month)),
 k AS (SELECT corr(vw, ew) AS monthly_corr, regr_r2(vw, ew) AS monthly_r2, regr_slope(vw, ew) AS monthly_beta, abs(regr_intercept(vw, ew)) / nullif(sqrt(greatest(sum(e * x * e * x) + 1.5 * sum(l1) + sum(l2) + 0.5 * sum(l3), 0)) / sum(x * x), 0) AS monthly_alpha_abs_t, stddev_samp(vw - ew) * sqrt(12) AS monthly_te_annual, max(w) AS max_weight FROM zl),
 dp AS (SELECT date, avg(ret) AS ew, sum(ret * market_cap) / sum(market_cap) AS vw FROM panel GROUP BY 1), kd AS (SELECT corr(vw, ew) AS daily_corr FROM dp), v AS (SELECT * FROM k CROSS JOIN kd)
 SELECT {", ".join(f"CASE WHEN {n} IS NULL THEN 'n/a' WHEN {f'{n} BETWEEN {r[0]} AND {r[1]}' if isinstance(r, tuple) else f'{n} >= {r}'} THEN 'ok' ELSE 'CHECK' END AS {n}" for n, r in THRESHOLDS.items())} FROM v""")
def pf16(spark, sf_dir):
    """All seven flags of a portfolio against its benchmark."""
    w = u.weights(monthly(spark, sf_dir)).groupBy("month").agg(F.max("weight").alias("w"))
    s = u.portfolios(monthly(spark, sf_dir)).join(w, "month").withColumn("series", F.lit("all"))
    alpha = st.hac_ols(s, "vw", ["ew"], "series", "month", 3).where("variable = 'const'").select("series", F.abs("t").alias("monthly_alpha_abs_t"))
    month = s.groupBy("series").agg(F.corr("vw", "ew").alias("monthly_corr"), F.regr_r2("vw", "ew").alias("monthly_r2"), F.regr_slope("vw", "ew").alias("monthly_beta"), (F.stddev_samp(F.col("vw") - F.col("ew")) * F.sqrt(F.lit(12))).alias("monthly_te_annual"), F.max("w").alias("max_weight"))
    day = u.portfolios(daily_panel(spark, sf_dir), "date", weight="market_cap").agg(F.corr("vw", "ew").alias("daily_corr")).withColumn("series", F.lit("all"))
    return u.threshold_flags(month.join(alpha, "series").join(day, "series"), THRESHOLDS).select(*THRESHOLDS)


# Sorts and factors.

_GROUPS_SQL = f"""{CHAR_SQL}, dc AS (SELECT stock, last_day(month + INTERVAL 6 MONTH) AS month, market_cap AS dec_cap FROM chr WHERE month(month) = 12),
 jn AS (SELECT c.stock, year(c.month) AS formation, market_cap, CASE WHEN equity > 0 THEN equity END / CASE WHEN dec_cap > 0 THEN dec_cap END AS bm, op, ag AS inv FROM chr c LEFT JOIN dc ON dc.stock = c.stock AND dc.month = c.month WHERE month(c.month) = 6 AND market_cap > 0),
 sz AS (SELECT formation, quantile_cont(market_cap, 0.5) AS m FROM jn WHERE stock % 2 = 0 GROUP BY 1 HAVING count(*) >= 10),
 lo AS (SELECT stock, formation, market_cap, unnest(['bm', 'op', 'inv']) AS chr_, unnest([bm, op, inv]) AS value FROM jn), cb AS (SELECT formation, chr_, quantile_cont(value, 0.3) AS a, quantile_cont(value, 0.7) AS b FROM lo WHERE stock % 2 = 0 AND value IS NOT NULL GROUP BY 1, 2),
 gr AS (SELECT stock, formation, chr_, CASE WHEN market_cap <= m THEN 'S' ELSE 'B' END AS size, CASE WHEN value <= a THEN 'low' WHEN value > b THEN 'high' ELSE 'mid' END AS grp FROM lo JOIN sz USING (formation) LEFT JOIN cb USING (formation, chr_) WHERE value IS NOT NULL)"""


def _groups(spark, sf_dir):
    return st.june_groups(st.june_characteristics(characteristics(spark, sf_dir)), F.col("stock") % 2 == 0, ["bm", "op", "inv"], 10)


@query("ap4_june_groups", f"{_GROUPS_SQL} SELECT stock, formation, chr_ AS char, size, grp AS \"group\" FROM gr")
def ap4(spark, sf_dir):
    return _groups(spark, sf_dir).withColumn("formation", F.col("formation").cast("long"))


def _cell(c, s, g):
    return f"max(v) FILTER (chr_ = '{c}' AND size = '{s}' AND grp = '{g}')"


def _factor_sql():
    legs = {c: f"({_cell(c, 'S', 'high')} + {_cell(c, 'B', 'high')}) / 2 - ({_cell(c, 'S', 'low')} + {_cell(c, 'B', 'low')}) / 2" for c in ("bm", "op", "inv")}
    size = {c: f"({_cell(c, 'S', 'low')} + {_cell(c, 'S', 'mid')} + {_cell(c, 'S', 'high')}) / 3 - ({_cell(c, 'B', 'low')} + {_cell(c, 'B', 'mid')} + {_cell(c, 'B', 'high')}) / 3" for c in legs}
    return f"""{_GROUPS_SQL}, ce AS (SELECT m.month, chr_, size, grp, sum(ret * cap_lag) / sum(cap_lag) AS v FROM mon m JOIN gr ON gr.stock = m.stock AND gr.formation = year(m.month) - CASE WHEN month(m.month) <= 6 THEN 1 ELSE 0 END WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2, 3, 4),
 fa AS (SELECT month, {legs['bm']} AS hml, {legs['op']} AS rmw, -({legs['inv']}) AS cma, {size['bm']} AS smb_bm, {size['op']} AS so, {size['inv']} AS si FROM ce GROUP BY 1)
 SELECT month, round(hml, 8) AS hml, round(rmw, 8) AS rmw, round(cma, 8) AS cma, round(smb_bm, 8) AS smb_bm, round((smb_bm + so + si) / 3, 8) AS smb FROM fa"""


@query("ap5_four_factors", _factor_sql())
def ap5(spark, sf_dir):
    """Value, profitability, investment and size factors of two by three sorts."""
    f = st.factors(monthly(spark, sf_dir), _groups(spark, sf_dir), {"bm": ("hml", 1), "op": ("rmw", 1), "inv": ("cma", -1)})
    return _r(f, 8, "hml", "rmw", "cma", "smb_bm", "smb").select("month", "hml", "rmw", "cma", "smb_bm", "smb")


@query("ap7_report_events", f"""{WIDE_SQL} SELECT s.stock, s.report_month, s.sales, s.assets, s.equity, p.sales AS sales_prev, p.assets AS assets_prev, p.equity AS equity_prev, p.report_month AS prev_report_month, s.fye
 FROM fy s ASOF LEFT JOIN snaps p ON s.stock = p.stock AND last_day(s.report_month - INTERVAL 9 MONTH) >= p.report_month WHERE s.stock IN (SELECT stock FROM uni)""")
def ap7(spark, sf_dir):
    stated = annual_wide(spark, sf_dir).select("stock", "month", add_months(F.col("month"), F.when(F.col("stock") % 3 == 0, 5).when(F.col("stock") % 3 == 1, 11).otherwise(30)).alias("fye"))
    e = pit.report_events(annual_wide(spark, sf_dir), universe(spark, sf_dir), ITEMS, ["sales"], stated)
    return e.select("stock", "report_month", *ITEMS, *[f"{c}_prev" for c in ITEMS], "prev_report_month", "fye")


# The battery's whole tables.

@query("qc8_history_shares", f"{LONG_SQL}, f AS (SELECT variable, stock, count(*) AS n, date_diff('month', min(month), max(month)) + 1 AS span FROM p GROUP BY 1, 2) SELECT variable, count(*) AS firms, median(n) AS median_months, avg(CAST(span > n AS INT)) AS share_with_gaps, CAST(sum(span - n) AS DOUBLE) / sum(span) AS share_gap_months FROM f GROUP BY 1")
def qc8(spark, sf_dir):
    return q.history_shares(panel(spark, sf_dir))


@query("qc9_matching_in_period", f"""{LONG_SQL}, sp AS (SELECT variable, min(month) AS a, max(month) AS b FROM p GROUP BY 1), mi AS (SELECT DISTINCT variable, stock FROM p), un AS (SELECT DISTINCT variable, stock FROM uni JOIN sp ON month BETWEEN a AND b WHERE n_days >= 2 OR stock % 4 > 0),
 j AS (SELECT variable, mi.stock AS m, un.stock AS u FROM mi FULL JOIN un USING (variable, stock)) SELECT variable, count(m) AS firms, count(u) AS universe, count(m + u) AS both, CAST(count(m + u) AS DOUBLE) / greatest(count(m), 1) AS share_in_universe, CAST(count(m + u) AS DOUBLE) / greatest(count(u), 1) AS share_covered FROM j GROUP BY 1""")
def qc9(spark, sf_dir):
    return q.matching(panel(spark, sf_dir), universe(spark, sf_dir).where("n_days >= 2 or stock % 4 > 0"))


_LIFE_SQL = """lf AS (SELECT stock, min(month) AS first_price, max(month) AS last_price, any_value(delisting_date) AS delisting_date FROM un JOIN delistings USING (stock) GROUP BY 1)"""


@query("qc12_padding_and_staleness", f"""{LONG_SQL}, un AS (SELECT * FROM uni WHERE stock % 4 > 0 OR year(month) BETWEEN 1994 AND 1996), {_LIFE_SQL},
 lr AS (SELECT *, sum(CASE WHEN prev IS NULL OR value <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY variable, stock ORDER BY month ROWS UNBOUNDED PRECEDING) AS run FROM lg),
 ps AS (SELECT *, row_number() OVER (PARTITION BY variable, stock, run ORDER BY month) > 11 AS long FROM lr),
 x AS (SELECT ps.variable, ps.stock, ps.month, ps.value, ps.long, un.stock IS NOT NULL AS alive, lf.* EXCLUDE (stock), (SELECT max(month) FROM un) AS fin FROM ps LEFT JOIN un ON un.stock = ps.stock AND un.month = ps.month LEFT JOIN lf ON lf.stock = ps.stock),
 fr AS (SELECT variable, stock, count(*) AS n, count(last_price) AS m, count(*) FILTER (month > last_price) AS aft, count(*) FILTER (month < first_price) AS bef, count(*) FILTER (month > last_day(delisting_date)) AS del, count(*) FILTER (long AND value <> 0) AS st, count(*) FILTER (alive) AS al,
  count(*) FILTER (long AND value <> 0 AND alive) AS sa, count(*) FILTER (long AND value = 0 AND alive) AS za, bool_or(CASE WHEN last_price < fin THEN date_diff('month', last_price, month) > 12 END) AS padded FROM x GROUP BY 1, 2)
 SELECT variable, CAST(sum(m) AS BIGINT) AS matched, avg(CAST(padded AS INT)) AS dead_padded, CAST(sum(aft) AS DOUBLE) / nullif(sum(m), 0) AS after_last_price, CAST(sum(del) AS DOUBLE) / nullif(sum(m), 0) AS after_delisting, CAST(sum(bef) AS DOUBLE) / nullif(sum(m), 0) AS before_first_price,
  CAST(sum(st) AS DOUBLE) / sum(n) AS stale, CAST(sum(sa) AS DOUBLE) / greatest(sum(al), 1) AS stale_trading, CAST(sum(za) AS DOUBLE) / greatest(sum(al), 1) AS zero_runs_trading, avg(CAST(sa > 0 AS INT)) AS firms_stale FROM fr GROUP BY 1""")
def qc12(spark, sf_dir):
    """Values beside the life of a stock; a value of these annual items is stale from its twelfth month on."""
    uni = universe(spark, sf_dir).where("stock % 4 > 0 or year(month) between 1994 and 1996")
    life = uni.groupBy("stock").agg(F.min("month").alias("first_price"), F.max("month").alias("last_price")).join(delistings(daily_panel(spark, sf_dir)), "stock")
    return q.padding_and_staleness(panel(spark, sf_dir), uni, life, 11)


_DIST_SQL = f"""{LONG_SQL}, fy0 AS (SELECT variable, stock, year(month) AS year, arg_max(value, month) AS value FROM p GROUP BY 1, 2, 3),
 sc AS (SELECT variable, year, median(abs(value)) AS s FROM fy0 GROUP BY 1, 2), tx AS (SELECT fy0.*, CASE WHEN variable = 'assets' THEN CASE WHEN value > 0 THEN log10(value) END ELSE asinh(value / nullif(s, 0)) END AS x FROM fy0 JOIN sc USING (variable, year)),
 md AS (SELECT *, median(x) OVER (PARTITION BY variable, year) AS m FROM tx), ad AS (SELECT variable, year, median(abs(x - m)) * 1.4826 AS d FROM md GROUP BY 1, 2), di AS (SELECT variable, stock, year, value, CASE WHEN d > 1e-9 * (1 + abs(m)) THEN (x - m) / d END AS z FROM md JOIN ad USING (variable, year))"""


@query("qc17_implausible_shares", f"{_DIST_SQL} SELECT variable, count(*) AS firm_years, avg(CAST(value = 0 AS INT)) AS zero, avg(CAST(value < 0 AS INT)) AS negative, avg(CAST(value < 0 AND variable = 'assets' AS INT)) AS sign_violations, avg(CAST(coalesce(abs(z) > 5, false) AS INT)) AS extreme FROM di GROUP BY 1")
def qc17(spark, sf_dir):
    return q.implausible_shares(q.yearly_distances(panel(spark, sf_dir), ["assets"]), ["assets"], 5.0)


@query("qc17_largest_distances", f"{_DIST_SQL}, rk AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY round(abs(z), 6) DESC, stock, year) AS rank FROM di WHERE z IS NOT NULL) SELECT variable, stock, year, value, round(z, 5) AS z, rank FROM rk WHERE rank <= 25")
def qc17_largest(spark, sf_dir):
    """The 25 firm-years of each variable that lie farthest out."""
    d = q.yearly_distances(panel(spark, sf_dir), ["assets"]).withColumn("_z", F.col("z")).withColumn("z", F.round("z", 6))
    return q.largest_distances(d).select("variable", "stock", F.col("year").cast("long").alias("year"), "value", F.round("_z", 5).alias("z"), F.col("rank").cast("long").alias("rank"))


# Emissions, classifications and files.

_EW_SQL = WIDE_SQL + ", ew AS (SELECT stock, month, CASE WHEN stock % 4 = 0 THEN sales END AS total, CASE WHEN stock % 4 = 1 THEN assets * 0.25 END AS scope1, CASE WHEN stock % 4 = 1 THEN equity * 0.5 END AS scope2, CASE WHEN stock % 4 <> 3 THEN assets END AS estimate FROM pos)"


@query("ec2_availability_groups", f"{_EW_SQL}, gx AS (SELECT stock, month, total IS NOT NULL OR scope1 IS NOT NULL OR scope2 IS NOT NULL AS any_reported, scope1 IS NOT NULL AND scope2 IS NOT NULL AS scope12_reported, estimate IS NOT NULL AS estimated FROM ew) SELECT *, any_reported OR estimated AS reported_or_estimated, estimated AND NOT any_reported AS estimated_only FROM gx WHERE any_reported OR estimated")
def ec2(spark, sf_dir):
    k = F.col("stock") % 4
    w = clean(spark, sf_dir).select("stock", "month", F.when(k == 0, F.col("sales")).alias("total"), F.when(k == 1, F.col("assets") * 0.25).alias("scope1"), F.when(k == 1, F.col("equity") * 0.5).alias("scope2"), F.when(k != 3, F.col("assets")).alias("estimate"))
    return pit.availability_groups(w, ["total", "scope1", "scope2"], ["scope1", "scope2"], "estimate").drop("total", "scope1", "scope2", "estimate")


def _growth_sql(out, name, variable):
    return f"{out}0 AS (SELECT stock, month, value FROM lg WHERE variable = '{variable}' AND (prev IS NULL OR prev <> value) AND value > 0), {out} AS (SELECT stock, month, row_number() OVER w AS k, CASE WHEN date_diff('month', lag(month) OVER w, month) BETWEEN 10 AND 14 THEN ln(value / lag(value) OVER w) END AS {name} FROM {out}0 WINDOW w AS (PARTITION BY stock ORDER BY month))"


@query("ec15_fiscal_alignment", f"""{LONG_SQL}, {_growth_sql('ge', 'de', 'assets')}, {_growth_sql('gs', 'ds', 'sales')},
 aj AS (SELECT e.stock, e.month, e.de, s.k FROM ge e ASOF JOIN gs s ON e.stock = s.stock AND e.month >= s.month WHERE e.de IS NOT NULL), ao AS (SELECT stock, month, de, o AS "offset", k + o AS k FROM aj CROSS JOIN (SELECT unnest([-1, 0, 1]) AS o)),
 ad0 AS (SELECT "offset", year(ao.month) AS y, de, ds FROM ao JOIN gs USING (stock, k) WHERE abs(de) < 3 AND abs(ds) < 3), ay AS (SELECT "offset", 0 AS year, de, ds FROM ad0 UNION ALL SELECT "offset", y, de, ds FROM ad0 WHERE y IN (1994, 1995, 1996)),
 ar AS (SELECT *, rank() OVER (PARTITION BY "offset", year ORDER BY de) + (count(*) OVER (PARTITION BY "offset", year, de) - 1) / 2 AS a, rank() OVER (PARTITION BY "offset", year ORDER BY ds) + (count(*) OVER (PARTITION BY "offset", year, ds) - 1) / 2 AS b FROM ay)
 SELECT "offset", year, count(*) AS n, round(CASE WHEN year = 0 OR count(*) >= 30 THEN corr(a, b) END, 7) AS spearman, round(median(de), 7) AS median FROM ar GROUP BY 1, 2""")
def ec15(spark, sf_dir):
    """Growth of one annual variable against another's update before, at and after it."""
    p = panel(spark, sf_dir)
    e, s = (p.where(F.col("variable") == v).select("stock", "month", "value") for v in ("assets", "sales"))
    return _r(q.fiscal_alignment(e, s, [1994, 1995, 1996]), 7, "spearman", "median").withColumns({"offset": F.col("offset").cast("int"), "year": F.col("year").cast("long")})


@query("ec16_patched_ids", f"{PANEL_SQL} SELECT stock, country, coalesce(CASE WHEN stock % 3 > 0 THEN 'C' || company END, 'C' || company) AS company_id, 'E' || (company // 2) AS entity_id FROM statics WHERE acctbal > 0")
def ec16(spark, sf_dir):
    """Statics of the report's stocks with the company ids that only the unfiltered statics have."""
    s = statics(spark, sf_dir)
    full = s.select("stock", F.concat(F.lit("C"), F.col("company").cast("string")).alias("company_id"), F.concat(F.lit("E"), F.floor(F.col("company") / 2).cast("string")).alias("entity_id"))
    kept = s.where("acctbal > 0").select("stock", "country", F.when(F.col("stock") % 3 > 0, F.concat(F.lit("C"), F.col("company").cast("string"))).alias("company_id"))
    return pit.patched_ids(kept, full, ["company_id", "entity_id"])


_FIELD_SQL = """fl AS (SELECT stock, CASE WHEN stock % 5 > 0 THEN country END AS industry, CASE WHEN stock % 3 > 0 THEN region END AS sector FROM statics),
 gm AS (SELECT stock, month, market_cap, unnest(list_filter(['universe', CASE WHEN emission IS NOT NULL THEN 'any' END, CASE WHEN NOT estimated THEN 'reported' END, CASE WHEN estimated THEN 'estimated only' END], lambda x: x IS NOT NULL)) AS grp FROM em6)"""


def _group_months(spark, sf_dir):
    e = emission_panel(spark, sf_dir)
    groups = F.array_compact(F.array(F.lit("universe"), F.when(F.col("emission").isNotNull(), F.lit("any")), F.when(~F.col("estimated"), F.lit("reported")), F.when(F.col("estimated"), F.lit("estimated only"))))
    return e.select("stock", "month", "market_cap", groups.alias("groups"))


def _fields(spark, sf_dir):
    return statics(spark, sf_dir).select("stock", F.when(F.col("stock") % 5 > 0, F.col("country")).alias("industry"), F.when(F.col("stock") % 3 > 0, F.col("region")).alias("sector"))


@query("dg2_field_coverage", f"""{EM_SQL}, {_FIELD_SQL}, ld AS (SELECT max(month) AS m FROM em6 WHERE month(month) = 12), g1 AS (SELECT grp, gm.stock, count(*) AS n, sum(market_cap) FILTER (month = (SELECT m FROM ld)) AS cap, any_value(industry) AS industry, any_value(sector) AS sector FROM gm LEFT JOIN fl ON fl.stock = gm.stock GROUP BY 1, 2),
 g2 AS (SELECT grp, n, cap, unnest(['industry', 'sector']) AS field, unnest([industry IS NOT NULL, sector IS NOT NULL]) AS has FROM g1)
 SELECT grp AS "group", field, count(*) AS n_stocks, avg(CAST(has AS INT)) AS share_stocks, CAST(sum(n) FILTER (has) AS DOUBLE) / sum(n) AS share_months, round(coalesce(sum(cap) FILTER (has), 0) / sum(cap), 9) AS vw_share FROM g2 GROUP BY 1, 2""")
def dg2(spark, sf_dir):
    return _r(q.field_coverage(_group_months(spark, sf_dir), _fields(spark, sf_dir), ["industry", "sector"]), 9, "vw_share")


@query("dg2_category_counts", f"""{EM_SQL}, {_FIELD_SQL} SELECT grp AS "group", coalesce(sector, '(missing)') AS category, count(DISTINCT gm.stock) AS stocks FROM gm LEFT JOIN fl ON fl.stock = gm.stock GROUP BY 1, 2""")
def dg2_categories(spark, sf_dir):
    return q.category_counts(_group_months(spark, sf_dir), _fields(spark, sf_dir), "sector")


@query("em2_emission_snapshots", f"{EM_SQL} SELECT stock, report_month, fye, total, scope1, scope2, estimate FROM em1 WHERE total IS NOT NULL OR scope1 IS NOT NULL OR scope2 IS NOT NULL OR estimate IS NOT NULL")
def em2(spark, sf_dir):
    """Snapshots of the emission items with lone unit errors cleared; those without any item go."""
    return em.clean_snapshots(emission_snapshots(spark, sf_dir), "total", ["total", "scope1", "scope2", "estimate"]).select("stock", "report_month", "fye", "total", "scope1", "scope2", "estimate")


@query("em5_emission_availability", f"{EM_SQL} SELECT stock, report_month, fye, available, emission FROM em5")
def em5(spark, sf_dir):
    """First month of use of each emission value, twelve months after its fiscal year."""
    e = pit.emission_values(pit.lone_unit_errors(emission_snapshots(spark, sf_dir), "total"), dated(spark, sf_dir))
    return pit.availability(e, 12).select("stock", "report_month", "fye", "available", "emission")


@query("eu1_local_and_euro_returns", f"""{PANEL_SQL}, x AS (SELECT *, round(return_index * (1 + month(month) / 100), 6) AS ri_eur, market_cap * 0.9 AS cap_eur FROM uni), w1 AS (SELECT *, date_diff('month', lag(month) OVER w, month) = 1 AS near, lag(return_index) OVER w AS a, lag(ri_eur) OVER w AS b, lag(cap_eur) OVER w AS c FROM x WINDOW w AS (PARTITION BY stock ORDER BY month))
 SELECT stock, month, CASE WHEN near THEN round(return_index / a - 1, 7) END AS ret_local, CASE WHEN near THEN round(ri_eur / b - 1, 7) END AS ret_eur, CASE WHEN near THEN round(c, 4) END AS cap_lag_eur FROM w1""")
def eu1(spark, sf_dir):
    """Monthly returns in local currency and euro, and the lagged euro cap, over consecutive months."""
    x = universe(spark, sf_dir).withColumns({"ri_eur": F.round(F.col("return_index") * (1 + F.month("month") / 100), 6), "market_cap": F.col("market_cap") * 0.9})
    m = u.consecutive_returns(u.consecutive_returns(x, "ri_eur", "ret_eur").drop("cap_lag"), "return_index", "ret_local")
    return m.select("stock", "month", F.round("ret_local", 7).alias("ret_local"), F.round("ret_eur", 7).alias("ret_eur"), F.round("cap_lag", 4).alias("cap_lag_eur"))


@query("pit1_months_between", "SELECT o_orderkey AS id, date_diff('month', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS months, last_day(last_day(CAST(o_orderdate AS DATE)) + INTERVAL 7 MONTH) AS later, last_day(last_day(CAST(o_orderdate AS DATE)) - INTERVAL 9 MONTH) AS earlier FROM orders")
def pit1(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), months_between(F.lit("1998-08-02").cast("date"), d).cast("long").alias("months"), add_months(d, 7).alias("later"), add_months(d, -9).alias("earlier"))


@query("src6_stacked_statics", "SELECT 'customer' AS folder, c_custkey AS code, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier")
def src6(spark, sf_dir):
    """Statics of several files under one schema, tagged with the file that they come from."""
    s = im.stack_files(spark, [f"{sf_dir}/customer.parquet", f"{sf_dir}/supplier.parquet"], r"(\w+)\.parquet")
    return s.select("folder", F.coalesce("c_custkey", "s_suppkey").alias("code"), F.coalesce("c_name", "s_name").alias("name"))


@query("src21_registry", "SELECT 'V' || p_partkey AS code, p_brand AS label, CASE WHEN p_size % 4 > 0 THEN CAST(p_size AS INT) END AS scale FROM part WHERE p_size % 7 > 0")
def src21(spark, sf_dir):
    """Registry lines that Spark makes from the parts: some are comments, some have a cell that is no number."""
    k = F.col("p_size")
    line = F.concat(F.lit("V"), F.col("p_partkey").cast("string"), F.lit(", "), "p_brand", F.lit(" ,"), F.when(k % 4 > 0, k.cast("string")).otherwise(""))
    text = read(spark, sf_dir, "part").select(F.when(k % 7 == 0, F.concat(F.lit(" # "), line)).otherwise(line).alias("text"))
    return im.registry(text, "code string, label string, scale int")


@query("src27_survivor_statics", f"{PANEL_SQL} SELECT stock, ename, country FROM statics WHERE stock IN (SELECT stock FROM panel WHERE unadj_close > 0 GROUP BY stock HAVING count(*) >= 20 AND stddev_samp(ret) <= 0.0375)")
def src27(spark, sf_dir):
    """Statics of the stocks that a screened panel still has."""
    p = fl.high_volatility(fl.nonsense_prices(daily_panel(spark, sf_dir)), 0.0375)
    p = p.join(p.groupBy("stock").count().where("count >= 20"), "stock", "left_semi")
    return im.survivor_statics(statics(spark, sf_dir), p).select("stock", "ename", "country")


def _drop_stocks(name, source, condition):
    return f"{name} AS (SELECT * FROM {source} WHERE stock NOT IN (SELECT stock FROM {source} GROUP BY stock HAVING {condition}))"


_RUN = "return_index IS NULL OR NOT coalesce(return_index = lag(return_index) OVER (PARTITION BY stock ORDER BY date), false)"


@query("fo10_european_order", f"""{PANEL_SQL}, x0 AS (SELECT p.* EXCLUDE (ret, unadj_close), country, round(return_index * (1 + month(date) / 100), 6) AS return_index_eur, CASE WHEN day(date) % 13 > 0 THEN unadj_close END AS unadj_close, unadj_close * 0.9 AS unadj_close_eur FROM panel p JOIN statics USING (stock)),
 x1 AS (SELECT *, return_index / lag(return_index) OVER w - 1 AS ret, return_index_eur / lag(return_index_eur) OVER w - 1 AS ret_eur FROM x0 WINDOW w AS (PARTITION BY stock ORDER BY date)),
 x2 AS (SELECT * FROM x1 WHERE country IN (SELECT country FROM x1 GROUP BY country HAVING count(DISTINCT stock) >= 3)),
 {_drop_stocks("x3", "x2", "avg(CAST(ret > 0 AS INT)) FILTER (ret <> 0) > 0.7 OR 1 - avg(CAST(ret > 0 AS INT)) FILTER (ret <> 0) > 0.7")},
 p1 AS (SELECT x3.*, delisting_date, max(CASE WHEN coalesce(ret, 0) <> 0 THEN date END) OVER (PARTITION BY stock) AS live FROM x3 JOIN delistings USING (stock) WHERE delisting_date IS NULL OR date <= delisting_date),
 p2 AS (SELECT *, sum(CAST(live IS NULL OR date > live AS INT)) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS tail FROM p1), x4 AS (SELECT * EXCLUDE (delisting_date, live, tail) FROM p2 WHERE NOT (live IS NULL OR date > live) OR tail <= 9 OR delisting_date IS NULL),
 cl AS (SELECT country, max(date) AS last FROM x4 GROUP BY 1), x5 AS (SELECT * FROM x4 WHERE stock IN (SELECT stock FROM x4 JOIN cl USING (country) GROUP BY stock HAVING count(*) >= 200 OR date_diff('day', min(date), any_value(last)) < 200)),
 {_drop_stocks("x6", "x5", "avg(CAST(coalesce(ret = 0, false) AS INT)) > 0.3")},
 r1 AS (SELECT *, {_RUN} AS fresh FROM x6), r2 AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM r1), r3 AS (SELECT *, row_number() OVER (PARTITION BY stock, run ORDER BY date) AS place FROM r2), x7 AS (SELECT * EXCLUDE (fresh, run, place) FROM r3 WHERE place <= 3),
 {_drop_stocks("x8", "x7", "stddev_samp(ret) > 0.0375")}, {_drop_stocks("x9", "x8", "stddev_samp(ret) < 1e-6")},
 o1 AS (SELECT *, coalesce((ret > 0.06 AND lead(ret) OVER w < -0.04) OR (ret < -0.04 AND lead(ret) OVER w > 0.06), false) AS pair FROM x9 WINDOW w AS (PARTITION BY stock ORDER BY date)), o2 AS (SELECT *, pair OR coalesce(lag(pair) OVER (PARTITION BY stock ORDER BY date), false) AS bad FROM o1), x10 AS (SELECT * EXCLUDE (pair, bad) FROM o2 WHERE NOT bad),
 hs AS (SELECT country, count(DISTINCT stock) AS n FROM x10 GROUP BY 1), hd AS (SELECT country, date FROM x10 JOIN hs USING (country) GROUP BY country, date, n HAVING count(*) FILTER (ret <> 0) >= 0.3 * n), x11 AS (SELECT x10.* FROM x10 SEMI JOIN hd USING (country, date)),
 x12 AS (SELECT * FROM x11 WHERE NOT coalesce(abs(close - unadj_close * adj_factor) / nullif(unadj_close * adj_factor, 0) > 0.06, false)), x13 AS (SELECT * FROM x12 WHERE NOT coalesce(unadj_close <= 0, false) AND NOT coalesce(high < greatest(open, close, low), false) AND NOT coalesce(low > least(open, close, high), false)),
 t1 AS (SELECT *, coalesce(high = lag(high) OVER w AND low = lag(low) OVER w AND volume = lag(volume) OVER w, false) AS same FROM x13 WINDOW w AS (PARTITION BY stock ORDER BY date)), x14 AS (SELECT * EXCLUDE (same) FROM t1 WHERE NOT same),
 m1 AS (SELECT *, min(CASE WHEN unadj_close IS NOT NULL THEN date END) OVER (PARTITION BY stock) AS ready FROM x14), x15 AS (SELECT * EXCLUDE (ready, unadj_close), last_value(unadj_close IGNORE NULLS) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS unadj_close FROM m1 WHERE date >= ready),
 l1 AS (SELECT x15.*, row_number() OVER (PARTITION BY stock ORDER BY date DESC) = 1 AND delisting_date IS NOT NULL AS gone FROM x15 LEFT JOIN delistings USING (stock)),
 x16 AS (SELECT stock, date, country, unadj_close, unadj_close_eur, gone, CASE WHEN gone THEN (1 + coalesce(ret, 0)) * (1 - 0.35) - 1 ELSE ret END AS ret, CASE WHEN gone THEN return_index_eur * (1 - 0.35) ELSE return_index_eur END AS return_index_eur FROM l1),
 pm AS (SELECT stock, country, last_day(date) AS month, arg_max(unadj_close_eur, date) AS v FROM x16 GROUP BY 1, 2, 3), pv AS (SELECT *, lag(v) OVER (PARTITION BY stock ORDER BY month) AS prev FROM pm), pc AS (SELECT pv.country, pv.month, quantile_cont(prev, 0.1) AS cut FROM x16 JOIN pv ON pv.stock = x16.stock AND pv.month = last_day(x16.date) GROUP BY 1, 2),
 pb AS (SELECT stock, pv.month FROM pv JOIN pc ON pc.country = pv.country AND pc.month = pv.month WHERE prev < cut)
 SELECT stock, date, country, gone AS delisted, round(ret, 8) AS ret, round(return_index_eur + 1e-9, 6) AS return_index_eur, round(unadj_close + 1e-9, 6) AS unadj_close FROM x16 WHERE NOT EXISTS (SELECT 1 FROM pb WHERE pb.stock = x16.stock AND pb.month = last_day(x16.date)) AND date > DATE '1992-06-30' AND date <= DATE '1998-06-30'""")
def fo10(spark, sf_dir):
    """All screens of the panel of many countries, local and euro series side by side."""
    p, prices = daily_sums(spark, sf_dir)
    p = p.join(statics(spark, sf_dir).select("stock", "country"), "stock").withColumn("return_index_eur", F.round(F.col("return_index") * (1 + F.month("date") / 100), 6))
    price = prices["unadj_close"]
    later = {c: prices[c] for c in ("open", "high", "low", "close", "adj_factor")} | {"unadj_close": F.when(F.dayofmonth("date") % 13 > 0, price), "unadj_close_eur": price * 0.9}
    gone = written(delistings(last_days(spark, sf_dir)))  # a small table that is read twice
    out = fl.european_order(p, gone, after="1992-06-30", until="1998-06-30", least=3, one_sign=0.7, history=200, zero=0.3, run=3, high=0.0375, up=0.06, down=-0.04, active=0.3, gap=0.06, penny=0.1, later=later)
    # Both columns are moved off rounding ties.
    out = out.withColumns({c: F.col(c) + 1e-9 for c in ("return_index_eur", "unadj_close")})
    return _r(_r(out, 8, "ret"), 6, "return_index_eur", "unadj_close").select("stock", "date", "country", "delisted", "ret", "return_index_eur", "unadj_close")
