"""Queries of emission tables, comparisons with published series, event studies and value diagnostics, on the proxy panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.dates import add_months
from ledgerline.operators import diagnostics as dg
from ledgerline.operators import emissions as em
from ledgerline.operators import pit
from ledgerline.operators import statistics as st
from ledgerline.operators import universe as u
from ledgerline.plans.check_queries import LONG_SQL, _r, _year, panel
from ledgerline.plans.listing_queries import frame
from ledgerline.plans.pit_queries import EM_SQL, WIDE_SQL, snapshots
from ledgerline.plans.registry import query
from ledgerline.plans.study_queries import _FIELD_SQL, _fields, _group_months, clean
from ledgerline.plans.universe_queries import _SERIES, monthly, universe
from ledgerline.sources.proxy import PANEL_SQL, statics

# Emission items of the proxy: a reported total, two scopes or an estimate, by the number of the stock.
ITEMS = {"reported": ["total", "scope1", "scope2"], "scopes": ["scope1", "scope2"], "estimate": "estimate"}
_ITEM_SQL = WIDE_SQL + """, ew AS (SELECT stock, month, CASE WHEN stock % 8 = 0 THEN assets * 1.0005 WHEN stock % 4 = 0 THEN sales END AS total, CASE WHEN stock % 4 = 1 AND year(month) > 1994 THEN assets * 0.25 END AS scope1, CASE WHEN stock % 4 = 1 THEN equity * 0.5 END AS scope2, CASE WHEN stock % 4 <> 3 AND NOT (stock % 8 = 4 AND year(month) = 1995) THEN assets END AS estimate FROM pos),
 gx AS (SELECT *, total IS NOT NULL OR scope1 IS NOT NULL OR scope2 IS NOT NULL AS any_reported, scope1 IS NOT NULL AND scope2 IS NOT NULL AS scope12_reported, estimate IS NOT NULL AS estimated FROM ew),
 gw AS (SELECT *, any_reported OR estimated AS reported_or_estimated, estimated AND NOT any_reported AS estimated_only FROM gx WHERE any_reported OR estimated),
 sz AS (SELECT month, quantile_cont(market_cap, 0.5) AS c1 FROM uni GROUP BY 1), su AS (SELECT uni.*, 1 + CAST(market_cap > c1 AS INT) AS size_group FROM uni JOIN sz USING (month)),
 cs AS (SELECT su.stock, su.month, year(su.month) AS year, market_cap, size_group, total, scope1, scope2, estimate, """ + ", ".join(f"coalesce({g}, false) AS {g}" for g in em.GROUPS) + """ FROM su LEFT JOIN gw ON gw.stock = su.stock AND gw.month = su.month WHERE month(su.month) = 12)"""


def wide(spark, sf_dir):
    k, y = F.col("stock"), F.year("month")
    return clean(spark, sf_dir).select(
        "stock", "month", F.when(k % 8 == 0, F.col("assets") * 1.0005).when(k % 4 == 0, F.col("sales")).alias("total"), F.when((k % 4 == 1) & (y > 1994), F.col("assets") * 0.25).alias("scope1"), F.when(k % 4 == 1, F.col("equity") * 0.5).alias("scope2"),
        F.when((k % 4 != 3) & ~((k % 8 == 4) & (y == 1995)), F.col("assets")).alias("estimate"),
    )


def sized(spark, sf_dir):
    return u.size_groups(universe(spark, sf_dir), F.lit(True), 2)


@query("ec1_raw_overview", f"""{LONG_SQL}, fyk AS (SELECT variable, year(month) AS y, count(DISTINCT stock) AS k FROM p GROUP BY 1, 2), d AS (SELECT variable, stock, count(DISTINCT value) AS k FROM p GROUP BY 1, 2), v AS (SELECT unnest(['assets', 'equity', 'sales', 'nothing']) AS variable)
 SELECT v.variable, coalesce(firms, 0) AS firms, coalesce(firm_months, 0) AS firm_months, first, last, a AS first_year_5_firms, b AS first_year_100000_firms, kinds AS median_distinct_values, zero AS share_zero, negative AS share_negative, p01, p50, p99 FROM v
 LEFT JOIN (SELECT variable, count(DISTINCT stock) AS firms, count(*) AS firm_months, min(month) AS first, max(month) AS last, avg(CAST(value = 0 AS INT)) AS zero, avg(CAST(value < 0 AS INT)) AS negative, round(quantile_cont(value, 0.01) + 3e-6, 4) AS p01, round(quantile_cont(value, 0.5) + 3e-6, 4) AS p50, round(quantile_cont(value, 0.99) + 3e-6, 4) AS p99 FROM p GROUP BY 1) USING (variable)
 LEFT JOIN (SELECT variable, min(y) FILTER (k >= 5) AS a, min(y) FILTER (k >= 100000) AS b FROM fyk GROUP BY 1) USING (variable) LEFT JOIN (SELECT variable, median(k) AS kinds FROM d GROUP BY 1) USING (variable)""")
def ec1(spark, sf_dir):
    """Raw items, one of the registered ones without data, and a number of firms that no year reaches."""
    p = panel(spark, sf_dir)
    out = em.raw_overview(p, frame(spark, [(v,) for v in ("assets", "equity", "sales", "nothing")], "variable string"), (5, 100000))
    years = {c: F.col(c).cast("long") for c in ("first_year_5_firms", "first_year_100000_firms")}
    return out.withColumns(years | {c: F.round(F.col(c) + 3e-6, 4) for c in ("p01", "p50", "p99")})  # off rounding ties


_CELLS = ", ".join(f"{c} IS NOT NULL" for c in (*ITEMS["reported"], "estimate")) + ", " + ", ".join(em.GROUPS)
_NAMES = ", ".join(f"'{c}'" for c in (*ITEMS["reported"], "estimate", *em.GROUPS))


@query("ec3_group_coverage", f"{_ITEM_SQL}, l AS (SELECT year, market_cap, unnest([{_NAMES}]) AS field, unnest([{_CELLS}]) AS has FROM cs) SELECT year, field, count(*) AS n_universe, round(sum(market_cap) / 1000, 5) AS cap_bn, count(*) FILTER (has) AS n, round(avg(CAST(has AS INT)), 9) AS ew, round(coalesce(sum(market_cap) FILTER (has), 0) / sum(market_cap), 9) AS vw FROM l GROUP BY 1, 2")
def ec3(spark, sf_dir):
    """Coverage of items and availability groups on the December cross-sections."""
    return _year(_r(_r(em.coverage_by_year(wide(spark, sf_dir), universe(spark, sf_dir), ITEMS), 9, "ew", "vw"), 5, "cap_bn"))


@query("ec4_firm_counts", f"""{_ITEM_SQL}, ss AS (SELECT DISTINCT stock FROM uni WHERE year(month) >= 1996), ever AS (SELECT unnest([{', '.join(f"'{g}'" for g in em.GROUPS)}]) AS grp, unnest([{', '.join(em.GROUPS)}]) AS has, stock FROM gw WHERE stock IN (FROM ss)),
 yrs AS (SELECT unnest(['universe', {', '.join(f"'{g}'" for g in em.GROUPS)}]) AS grp, unnest([true, {', '.join(em.GROUPS)}]) AS has FROM cs WHERE year >= 1996), e AS (SELECT grp, count(DISTINCT stock) FILTER (has) AS stocks FROM ever GROUP BY 1 UNION ALL SELECT 'universe', count(*) FROM ss)
 SELECT grp AS "group", stocks, stock_years, stocks / (SELECT count(*) FROM ss) AS share FROM e JOIN (SELECT grp, count(*) FILTER (has) AS stock_years FROM yrs GROUP BY 1) USING (grp)""")
def ec4(spark, sf_dir):
    """Stocks ever, and stock-years, in each availability group."""
    return em.firm_counts(wide(spark, sf_dir), universe(spark, sf_dir), ITEMS, 1996)


@query("ec4_coverage_by_size", f"{_ITEM_SQL} SELECT year, CAST(size_group AS BIGINT) AS size_group, round(avg(CAST(reported_or_estimated AS INT)), 9) AS share, count(*) AS n FROM cs WHERE year >= 1994 GROUP BY 1, 2")
def ec4_size(spark, sf_dir):
    out = em.coverage_by_size(wide(spark, sf_dir), sized(spark, sf_dir), ITEMS, first_year=1994)
    return _year(_r(out, 9, "share")).withColumn("size_group", F.col("size_group").cast("long"))


@query("ec11_reported_vs_estimated", f"""{_ITEM_SQL}, x AS (SELECT year(month) AS year, total, estimate, CASE WHEN total > 0 THEN estimate / total END AS k FROM ew WHERE month(month) = 12 AND (total IS NOT NULL OR estimate IS NOT NULL))
 SELECT year, count(*) FILTER (estimate IS NULL) AS reported_only, count(*) FILTER (total IS NULL) AS estimated_only, count(k) AS both, round(avg(CAST(abs(k - 1) <= 0.001 AS INT)), 9) AS share_equal, round(median(k), 7) AS median, round(quantile_cont(k, 0.1), 7) AS p10, round(quantile_cont(k, 0.9), 7) AS p90 FROM x GROUP BY 1""")
def ec11(spark, sf_dir):
    """Reported totals beside estimates on the December rows."""
    return _year(_r(_r(em.reported_vs_estimated(wide(spark, sf_dir), "total", "estimate"), 7, "median", "p10", "p90"), 9, "share_equal"))


_EXAMPLES = "pt AS (SELECT unnest(['1', '4', '7']) AS pattern), mx AS (SELECT stock, max(market_cap) AS cap FROM uni GROUP BY 1), ex AS (SELECT pattern, stock, ename, cap FROM mx JOIN statics USING (stock) JOIN pt ON contains(upper(ename), pattern) QUALIFY row_number() OVER (PARTITION BY pattern ORDER BY cap DESC, stock) = 1)"


def _examples(spark, sf_dir):
    return em.example_firms(statics(spark, sf_dir), universe(spark, sf_dir), frame(spark, [("1",), ("4",), ("7",)], "pattern string"))


@query("ec14_example_firms", f"{PANEL_SQL}, {_EXAMPLES} SELECT * FROM ex")
def ec14(spark, sf_dir):
    """For each pattern the firm with the largest cap ever whose name contains it."""
    return _examples(spark, sf_dir)


@query("ec14_example_events", f"""{_ITEM_SQL}, {_EXAMPLES}, fw AS (SELECT DISTINCT stock, ename FROM ex), lw AS (SELECT ew.*, {', '.join(f'lag({c}) OVER w AS {c}0' for c in (*ITEMS['reported'], 'estimate'))} FROM ew WHERE stock IN (SELECT stock FROM fw) WINDOW w AS (PARTITION BY stock ORDER BY month)),
 cg AS (SELECT stock, month, total, scope1, scope2, estimate, concat_ws(',', {', '.join(f"CASE WHEN {c} IS DISTINCT FROM {c}0 THEN '{c}' END" for c in (*ITEMS['reported'], 'estimate'))}) AS changed FROM lw), rp AS (SELECT DISTINCT stock, report_month AS month, true AS accounts FROM snaps WHERE stock IN (SELECT stock FROM fw))
 SELECT stock, month, ename AS firm, round(total, 4) AS total, round(scope1, 4) AS scope1, round(scope2, 4) AS scope2, round(estimate, 4) AS estimate, coalesce(changed, '') AS changed, coalesce(accounts, false) AS accounts, CAST(stock % 12 + 1 AS INT) AS fye_month FROM (SELECT * FROM cg WHERE changed <> '') FULL JOIN rp USING (stock, month) JOIN fw USING (stock) WHERE year(month) >= 1994""")
def ec14_events(spark, sf_dir):
    """What happens at the example firms: changes of the items and reports of the accounts."""
    fye = statics(spark, sf_dir).select("stock", (F.col("stock") % 12 + 1).cast("int").alias("fye_month"))
    reports = snapshots(spark, sf_dir).select("stock", F.col("report_month").alias("month"))
    return _r(em.example_events(wide(spark, sf_dir), reports, _examples(spark, sf_dir), fye, 1994), 4, "total", "scope1", "scope2", "estimate").select("stock", "month", "firm", "total", "scope1", "scope2", "estimate", "changed", "accounts", "fye_month")


# Comparisons with published series; lags of three months here.

def _long_run(source, key, terms):
    """SQL of the Newey-West t of several sums: (name, u, q, coefficient) over the rows of `source`, Bartlett weights with three lags."""
    lags = ", ".join(f"{u} * lag({u}, {k}) OVER w AS {n}{k}" for n, u, _, _ in terms for k in (1, 2, 3))
    own = ", ".join(f"{u} * {u} AS {n}0, {q} AS {n}q, {c} AS {n}c" for n, u, q, c in terms)
    t = ", ".join(f"any_value({n}c) / (sqrt(greatest(sum({n}0) + 1.5 * sum({n}1) + 1.0 * sum({n}2) + 0.5 * sum({n}3), 0)) / sum({n}q)) AS {n}_t, any_value({n}c) AS {n}" for n, *_ in terms)
    return f"(SELECT {key}, {t} FROM (SELECT {key}, {own}, {lags} FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY month)) GROUP BY {key})"


# The portfolio is the value-weighted one, the market the equally-weighted one less a made-up riskless rate.
_PORT = f"{_SERIES}, pd AS (SELECT month, vw AS port, ew - 0.001 * (month(month) % 3) AS mkt, 0.001 * (month(month) % 3) AS rf FROM s), pp AS (SELECT * FROM (VALUES ('early', DATE '1990-01-01', DATE '1996-12-31'), ('late', DATE '1997-01-01', DATE '2030-01-01'), ('all', DATE '1990-01-01', DATE '2030-01-01')) t(period, a, b))"
_COMPARED = """, cd AS (SELECT period, month, port, mkt, rf, port - rf AS x, mkt + rf AS m FROM pd JOIN pp ON month BETWEEN a AND b), fit AS (SELECT period, regr_slope(x, mkt) AS b, regr_intercept(x, mkt) AS a, avg(mkt) AS mm, sum(mkt) / sum(mkt * mkt) AS g FROM cd GROUP BY 1),
 re AS (SELECT cd.period, month, x - a - b * mkt AS e, mkt - mm AS xb, 1 - g * mkt AS xa, a, b FROM cd JOIN fit USING (period)), tt AS """ + _long_run("re", "period", [("alpha", "e * xa", "xa * xa", "a"), ("beta", "e * xb", "xb * xb", "b")])
_FIGURES = "count(*) AS n, min(month) AS start, max(month) AS \"end\", round(corr(port, m), 6) AS corr, round(regr_r2(x, mkt), 6) AS r2, round(avg(port) * 12, 8) AS mean_port, round(avg(m) * 12, 8) AS mean_mkt, round(avg(port - m) * 12, 8) AS mean_diff, round(stddev_samp(port - m) * sqrt(12), 8) AS tracking_error, round(stddev_samp(port) * sqrt(12), 8) AS vol_port, round(stddev_samp(m) * sqrt(12), 8) AS vol_mkt, round(any_value(alpha), 8) AS alpha, round(any_value(alpha) * 12, 8) AS alpha_annual, round(any_value(alpha_t), 5) AS alpha_t, round(any_value(beta), 6) AS beta, round(any_value(beta_t), 4) AS beta_t"
_EIGHT = ("mean_port", "mean_mkt", "mean_diff", "tracking_error", "vol_port", "vol_mkt", "alpha", "alpha_annual")


def _by_period(spark, sf_dir):
    rf = 0.001 * (F.month("month") % 3)
    s = u.portfolios(monthly(spark, sf_dir)).select("month", F.col("vw").alias("port"), (F.col("ew") - rf).alias("mkt_rf"), rf.alias("rf"))
    periods = frame(spark, [("early", "1990-01-01", "1996-12-31"), ("late", "1997-01-01", "2030-01-01"), ("all", "1990-01-01", "2030-01-01")], "period string, a string, b string")
    out = st.compare_to_market(s.join(periods, F.expr("month between cast(a as date) and cast(b as date)")), "period", "month", 12, 3)
    return _r(_r(_r(_r(out, 8, *_EIGHT), 6, "corr", "r2", "beta"), 5, "alpha_t"), 4, "beta_t")


@query("pf7_compare_to_market", f"{PANEL_SQL}{_PORT}{_COMPARED} SELECT {_FIGURES} FROM cd JOIN tt USING (period) WHERE period = 'all'")
def pf7(spark, sf_dir):
    """The value-weighted portfolio beside the market over the whole time."""
    return _by_period(spark, sf_dir).where("period = 'all'").drop("period")


@query("pf10_subperiods", f"{PANEL_SQL}{_PORT}{_COMPARED} SELECT period, {_FIGURES} FROM cd JOIN tt USING (period) GROUP BY 1")
def pf10(spark, sf_dir):
    """The same figures for each period; periods may overlap."""
    return _by_period(spark, sf_dir)


_PAIR = "SELECT month, 'ew' AS factor, avg(ret) AS v FROM mon WHERE ret IS NOT NULL AND cap_lag > 0{0} GROUP BY 1 UNION ALL SELECT month, 'vw', sum(ret * cap_lag) / sum(cap_lag) FROM mon WHERE ret IS NOT NULL AND cap_lag > 0{0} GROUP BY 1"


@query("ap6_compare_factors", f"""{PANEL_SQL}, cf AS (SELECT factor, month, a.v AS mine, b.v AS bench FROM ({_PAIR.format('')}) a JOIN ({_PAIR.format(' AND stock % 2 = 0')}) b USING (month, factor)), mn AS (SELECT cf.*, avg(mine) OVER (PARTITION BY factor) AS m1, avg(bench) OVER (PARTITION BY factor) AS m2 FROM cf), ce AS (SELECT factor, month, mine - m1 AS u1, bench - m2 AS u2, m1, m2 FROM mn),
 tt AS {_long_run('ce', 'factor', [('a', 'u1', '1', 'm1'), ('b', 'u2', '1', 'm2')])}
 SELECT factor, count(*) AS n, min(month) AS start, max(month) AS "end", round(corr(mine, bench), 6) AS corr, round(12 * avg(mine), 8) AS mean_mine, round(12 * avg(bench), 8) AS mean_bench, round(sqrt(12) * stddev_samp(mine), 8) AS vol_mine, round(sqrt(12) * stddev_samp(bench), 8) AS vol_bench, round(regr_slope(bench, mine), 6) AS slope, round(regr_r2(bench, mine), 6) AS r2, round(sqrt(12) * stddev_samp(mine - bench), 8) AS tracking_error, round(any_value(a_t), 5) AS t_mine, round(any_value(b_t), 5) AS t_bench
 FROM cf JOIN tt USING (factor) GROUP BY 1 HAVING count(*) >= 24""")
def ap6(spark, sf_dir):
    """Factors beside their benchmarks, here the same means over every other stock."""
    m = monthly(spark, sf_dir)
    long = lambda d, name: u.portfolios(d).unpivot("month", ["ew", "vw"], "factor", name)
    out = st.compare_factors(long(m, "mine").join(long(m.where("stock % 2 = 0"), "bench"), ["month", "factor"]), 3)
    return _r(_r(_r(out, 8, "mean_mine", "mean_bench", "vol_mine", "vol_bench", "tracking_error"), 6, "corr", "slope", "r2"), 5, "t_mine", "t_bench")


# Event study: the signal is the change of sales over the assets before; one stock in nine reports twice a year.
_COHORT_SQL = f"""{WIDE_SQL}, e0 AS (SELECT s.stock, s.report_month, s.sales, p.sales AS sales_prev, p.assets AS assets_prev, p.report_month AS before FROM snaps s ASOF JOIN snaps p ON s.stock = p.stock AND last_day(s.report_month - INTERVAL 9 MONTH) >= p.report_month),
 e1 AS (SELECT stock, last_day(report_month - INTERVAL 2 MONTH) AS event_month, (sales - sales_prev) / assets_prev AS signal FROM e0 WHERE sales IS NOT NULL AND sales_prev IS NOT NULL AND assets_prev > 0 AND date_diff('month', before, report_month) BETWEEN 9 AND 15), e2 AS (SELECT *, year(event_month) AS year, row_number() OVER (PARTITION BY year(event_month) ORDER BY signal, stock) AS r, count(*) OVER (PARTITION BY year(event_month)) AS n FROM e1),
 e3 AS (SELECT *, CAST(greatest(1, ((r - 1) * 4 + n - 2) // (n - 1)) AS INT) AS grp FROM e2 WHERE n >= 20), e4 AS (SELECT e3.*, k, last_day(event_month + to_months(CAST(k AS INT))) AS month FROM e3 CROSS JOIN (SELECT unnest(generate_series(-3, 12)) AS k)), ra AS (SELECT stock, month, ret - avg(ret) OVER (PARTITION BY month) AS ra FROM mon WHERE ret IS NOT NULL),
 c AS (SELECT k, event_month, avg(ra) FILTER (grp = 4) - avg(ra) FILTER (grp = 1) AS s FROM e4 JOIN ra USING (stock, month) GROUP BY 1, 2)"""


@query("ap8_cohort_spread", f"{_COHORT_SQL} SELECT CAST(k AS INT) AS k, round(avg(s), 8) AS spread, round(avg(s) / nullif(stddev_samp(s) / sqrt(count(*)), 0), 5) AS t, count(*) AS cohorts FROM c WHERE s IS NOT NULL GROUP BY 1")
def ap8_cohorts(spark, sf_dir):
    """Mean spread over cohorts of the months in which events fall, with its t."""
    s = pit.add_previous(snapshots(spark, sf_dir), ["sales", "assets"]).withColumn("fye", add_months(F.col("report_month"), -2))
    return _r(_r(st.cohort_spread(st.earnings_events(s, "sales", "assets"), monthly(spark, sf_dir), -3, 12, 4), 8, "spread"), 5, "t")


# Book values beside market-to-book: names with class words, legacy currencies, lines that are off by a factor.
_BM_SQL = f"""{PANEL_SQL}, bm AS (SELECT stock, month, 'R' || ((stock // 4) % 3) AS country, 'Firm ' || (stock // 4) || CASE stock % 4 WHEN 0 THEN ' SER. A' WHEN 1 THEN ' ''B''' WHEN 2 THEN ' pref DEAD - X' ELSE ' Plc of it' END AS name, 1 + day(last_date) / 10.0 AS mtbv,
  CASE WHEN stock % 50 = 49 AND month(month) = 3 THEN -1 ELSE 1 END * CASE stock % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 1 / 1.95583 WHEN 2 THEN 2.0 WHEN 3 THEN 0.5 WHEN 4 THEN 1.03 ELSE 1 / 6.55957 END * (1 + (month(month) - 6) / 100.0) / (1 + day(last_date) / 10.0) AS bm, CASE stock % 6 WHEN 1 THEN 'DM' WHEN 5 THEN 'FF' ELSE 'E' END AS currency FROM uni),
 ln0 AS (SELECT stock, country, name, any_value(currency) AS currency, median(mtbv * bm) AS ratio, count(*) AS months, quantile_cont(mtbv * bm, 0.1) AS q10, quantile_cont(mtbv * bm, 0.9) AS q90 FROM bm WHERE mtbv * bm > 0 GROUP BY 1, 2, 3),
 sm AS (SELECT DISTINCT stock, country, CASE stock % 4 WHEN 3 THEN 'FIRM ' || (stock // 4) || ' PLC' ELSE 'FIRM ' || (stock // 4) END AS stem FROM bm), mu AS (SELECT stock FROM sm QUALIFY count(*) OVER (PARTITION BY country, stem) > 1),
 ct AS (SELECT *, CASE currency WHEN 'DM' THEN 1.95583 WHEN 'FF' THEN 6.55957 END AS rate FROM ln0), ca AS (SELECT *, CASE WHEN ratio BETWEEN 0.95 AND 1.05 THEN 'ok' WHEN abs(ratio * rate - 1) < 0.03 THEN 'legacy_currency' WHEN ratio > 1.05 AND stock IN (FROM mu) THEN 'share_class' ELSE 'other' END AS category FROM ct)"""


def _consistency(spark, sf_dir):
    k, month = F.col("stock"), F.month("month")
    kind = F.when(k % 4 == 0, " SER. A").when(k % 4 == 1, " 'B'").when(k % 4 == 2, " pref DEAD - X").otherwise(" Plc of it")
    quarter = F.floor(k / 4)
    mtbv = 1 + F.dayofmonth("last_date") / 10.0
    factor = F.when(k % 6 == 0, 1.0).when(k % 6 == 1, 1 / 1.95583).when(k % 6 == 2, 2.0).when(k % 6 == 3, 0.5).when(k % 6 == 4, 1.03).otherwise(1 / 6.55957)
    sign = F.when((k % 50 == 49) & (month == 3), -1).otherwise(1)
    rows = universe(spark, sf_dir).select("stock", "month", F.concat(F.lit("R"), quarter % 3).alias("country"), F.concat(F.lit("Firm "), quarter, kind).alias("name"), mtbv.alias("mtbv"), (sign * factor * (1 + (month - 6) / 100.0) / mtbv).alias("bm"))
    currency = F.when(k % 6 == 1, "DM").when(k % 6 == 5, "FF").otherwise("E")
    return dg.value_consistency(rows, statics(spark, sf_dir).select("stock", currency.alias("currency")))


@query("dg1_value_consistency", f"{_BM_SQL} SELECT stock, country, name, currency, round(ratio, 7) AS ratio, months, round(q10, 7) AS q10, round(q90, 7) AS q90, category, round(1 / rate, 9) AS expected_legacy_ratio FROM ca")
def dg1(spark, sf_dir):
    """Why lines' market-to-book and book-to-market do not cancel."""
    return _r(_r(_consistency(spark, sf_dir), 7, "ratio", "q10", "q90"), 9, "expected_legacy_ratio")


@query("dg1_odd_lines", f"{_BM_SQL} SELECT country, category, count(*) AS lines FROM ca WHERE category <> 'ok' GROUP BY 1, 2")
def dg1_odd(spark, sf_dir):
    return dg.odd_lines(_consistency(spark, sf_dir))


_SHARES_SQL = f"""{PANEL_SQL}, sb AS (SELECT uni.stock, month, country, market_cap, close AS price, close * (1 + (year(month) % 3) / 10.0) AS price_unadjusted, CASE WHEN uni.stock % 9 <> 7 THEN round(1000 * market_cap / close * CASE uni.stock % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1.02 ELSE 2.0 END, 3) END AS shares, CASE WHEN month(month) % 4 > 0 THEN last_day(month - INTERVAL 3 MONTH) END AS report_month FROM uni JOIN statics USING (stock)),
 x0 AS (SELECT b.stock, b.month, b.country, unnest(['unadjusted', 'adjusted', 'adjusted_now']) AS basis, unnest([b.shares * f.price_unadjusted / f.market_cap, b.shares * f.price / f.market_cap, b.shares * b.price / b.market_cap]) AS r0 FROM sb b JOIN sb f ON f.stock = b.stock AND f.month = last_day(b.report_month - INTERVAL 1 MONTH) WHERE b.shares IS NOT NULL),
 sc AS (SELECT country, basis, pow(10, round(log10(median(r0)))) AS s FROM x0 GROUP BY 1, 2), rt AS (SELECT x0.*, r0 / s AS r FROM x0 JOIN sc USING (country, basis))"""


def _ratios(spark, sf_dir):
    k = F.col("stock")
    b = universe(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "country"), "stock")
    shares = F.round(1000 * F.col("market_cap") / F.col("close") * F.when(k % 3 == 0, 1.0).when(k % 3 == 1, 1.02).otherwise(2.0), 3)
    b = b.select("stock", "month", "country", "market_cap", F.col("close").alias("price"), (F.col("close") * (1 + F.year("month") % 3 / 10.0)).alias("price_unadjusted"), F.when(k % 9 != 7, shares).alias("shares"), F.when(F.month("month") % 4 > 0, add_months(F.col("month"), -3)).alias("report_month"))
    return dg.shares_ratios(b)


@query("dg4_shares_basis", f"{_SHARES_SQL}, md AS (SELECT basis, stock, median(r) AS m FROM rt GROUP BY 1, 2) SELECT basis, lines, within, above, below, rows_within FROM (SELECT basis, count(*) AS lines, round(avg(CAST(m BETWEEN 0.95 AND 1.05 AS INT)), 9) AS within, round(avg(CAST(m > 1.05 AS INT)), 9) AS above, round(avg(CAST(m < 0.95 AS INT)), 9) AS below FROM md GROUP BY 1) JOIN (SELECT basis, round(avg(CAST(r BETWEEN 0.95 AND 1.05 AS INT)), 9) AS rows_within FROM rt GROUP BY 1) USING (basis)")
def dg4(spark, sf_dir):
    """Reported shares against cap over price at the fiscal year end and now."""
    return _r(dg.shares_basis(_ratios(spark, sf_dir)), 9, "within", "above", "below", "rows_within")


@query("dg4_by_country", f"{_SHARES_SQL} SELECT country, basis, round(avg(CAST(r BETWEEN 0.95 AND 1.05 AS INT)), 9) AS rows_within FROM rt GROUP BY 1, 2")
def dg4_country(spark, sf_dir):
    return _r(dg.shares_basis_by_country(_ratios(spark, sf_dir)), 9, "rows_within")


_GROUP_STOCKS = "gs AS (SELECT DISTINCT grp, gm.stock, industry, sector FROM gm LEFT JOIN fl ON fl.stock = gm.stock)"


@query("dg2_field_combinations", f"{EM_SQL}, {_FIELD_SQL}, {_GROUP_STOCKS} SELECT grp AS \"group\", concat_ws('+', CASE WHEN industry IS NOT NULL THEN 'industry' END, CASE WHEN sector IS NOT NULL THEN 'sector' END) AS fields, count(*) AS stocks FROM gs GROUP BY 1, 2")
def dg2_combinations(spark, sf_dir):
    """Which of the fields the stocks of each group have."""
    return dg.field_combinations(_group_months(spark, sf_dir), _fields(spark, sf_dir), ["industry", "sector"])


@query("dg2_granularity", f"{EM_SQL}, {_FIELD_SQL}, {_GROUP_STOCKS}, cc AS (SELECT grp, field, category, count(*) AS n FROM (SELECT grp, unnest(['industry', 'sector']) AS field, unnest([industry, sector]) AS category FROM gs) WHERE category IS NOT NULL GROUP BY 1, 2, 3) SELECT grp AS \"group\", field, count(*) AS categories, count(*) FILTER (n < 5) AS under_5, count(*) FILTER (n < 10) AS under_10 FROM cc GROUP BY 1, 2")
def dg2_granularity(spark, sf_dir):
    """Categories of each field, and thin ones."""
    return dg.granularity(_group_months(spark, sf_dir), _fields(spark, sf_dir), ["industry", "sector"])


@query("dg2_largest_unclassified", f"{EM_SQL}, {_FIELD_SQL}, mc AS (SELECT stock, max(market_cap) AS cap FROM gm WHERE grp = 'any' GROUP BY 1) SELECT stock, cap, row_number() OVER (ORDER BY cap DESC, stock) AS rank FROM mc WHERE stock NOT IN (SELECT stock FROM fl WHERE industry IS NOT NULL) QUALIFY row_number() OVER (ORDER BY cap DESC, stock) <= 5")
def dg2_unclassified(spark, sf_dir):
    """The largest stocks with emissions but without an industry."""
    return dg.largest_unclassified(_group_months(spark, sf_dir), _fields(spark, sf_dir), "industry", "any", 5).withColumn("rank", F.col("rank").cast("long"))


# The December rows by year and the changes of the items decide how many rows each table of the report has.
@query("ec16_report_tables", f"""{_ITEM_SQL}, {_EXAMPLES}, fw AS (SELECT DISTINCT stock FROM ex), lw AS (SELECT ew.*, {', '.join(f'lag({c}) OVER w AS {c}0' for c in (*ITEMS['reported'], 'estimate'))} FROM ew WHERE stock IN (FROM fw) WINDOW w AS (PARTITION BY stock ORDER BY month)),
 ch AS (SELECT stock, month FROM lw WHERE year(month) >= 1994 AND ({' OR '.join(f'{c} IS DISTINCT FROM {c}0' for c in (*ITEMS['reported'], 'estimate'))}) UNION SELECT stock, report_month FROM snaps WHERE stock IN (FROM fw) AND year(report_month) >= 1994)
 SELECT 'raw_overview' AS "table", (SELECT count(DISTINCT v) FROM (SELECT unnest([CASE WHEN total IS NOT NULL THEN 'total' END, CASE WHEN scope1 IS NOT NULL THEN 'scope1' END, CASE WHEN scope2 IS NOT NULL THEN 'scope2' END, CASE WHEN estimate IS NOT NULL THEN 'estimate' END]) AS v FROM ew)) AS rows
 UNION ALL SELECT 'coverage_by_year', (SELECT 9 * count(DISTINCT year) FROM cs) UNION ALL SELECT 'coverage_by_size', (SELECT count(*) FROM (SELECT DISTINCT year, size_group FROM cs WHERE year >= 1994)) UNION ALL SELECT 'firm_counts', 6
 UNION ALL SELECT 'reported_vs_estimated', (SELECT count(DISTINCT year(month)) FROM ew WHERE month(month) = 12 AND (total IS NOT NULL OR estimate IS NOT NULL)) UNION ALL SELECT 'share_classes', 1 UNION ALL SELECT 'example_firms', (SELECT count(*) FROM ex) UNION ALL SELECT 'example_events', (SELECT count(*) FROM ch)""")
def ec16_tables(spark, sf_dir):
    """How many rows each table of the emission report has."""
    fye = statics(spark, sf_dir).select("stock", (F.col("stock") % 12 + 1).cast("int").alias("fye_month"))
    reports = snapshots(spark, sf_dir).select("stock", F.col("report_month").alias("month"))
    patterns = frame(spark, [("1",), ("4",), ("7",)], "pattern string")
    return em.table_sizes(em.report_tables(wide(spark, sf_dir), universe(spark, sf_dir), sized(spark, sf_dir), reports, statics(spark, sf_dir), patterns, fye, ITEMS, 1994))
