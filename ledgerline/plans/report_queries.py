"""Queries of reports and diagnostics that combine the operators of other modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import emissions as em
from ledgerline.operators import series as sr
from ledgerline.sources import imports as im
from ledgerline.operators import checks as q
from ledgerline.operators import statistics as st
from ledgerline.operators import universe as u
from ledgerline.plans.check_queries import LONG_SQL, _r, _year, panel
from ledgerline.plans.registry import query
from ledgerline.plans.universe_queries import monthly, universe
from ledgerline.sources.proxy import PANEL_SQL, daily_panel, read, statics

_SIZE = "c AS (SELECT month, quantile_cont(market_cap, 0.5) AS c1 FROM uni GROUP BY 1), sg AS (SELECT stock, month, 1 + CAST(market_cap > c1 AS INT) AS g FROM uni JOIN c USING (month))"


@query("qc6_coverage_by_size", f"""{LONG_SQL}, {_SIZE}, m AS (SELECT v.variable, sg.month, g, avg(CAST(p.stock IS NOT NULL AS INT)) AS s FROM sg CROSS JOIN (SELECT DISTINCT variable FROM p) v LEFT JOIN p ON p.variable = v.variable AND p.stock = sg.stock AND p.month = sg.month GROUP BY 1, 2, 3)
 SELECT variable, year(month) AS year, round(avg(s) FILTER (g = 1), 9) AS group_1, round(avg(s) FILTER (g = 2), 9) AS group_2 FROM m GROUP BY 1, 2""")
def qc6(spark, sf_dir):
    """Mean of monthly coverage by year and size group."""
    return _year(_r(q.coverage_by_size(panel(spark, sf_dir), u.size_groups(universe(spark, sf_dir), F.lit(True), 2), 2), 9, "group_1", "group_2"))


@query("ec7_lag_to_reports", f"""{LONG_SQL}, r AS (SELECT DISTINCT stock, month FROM ch WHERE variable = 'assets'), e AS (SELECT stock, month FROM ch WHERE variable = 'sales'), a AS (SELECT e.*, date_diff('month', r.month, e.month) AS lag FROM e ASOF LEFT JOIN r ON r.stock = e.stock AND e.month >= r.month)
 SELECT CAST(least(lag, 6) AS DOUBLE) AS lag, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM a GROUP BY 1""")
def ec7(spark, sf_dir):
    """Months from the latest change of one item to a change of another, long lags in one bin."""
    e = q.change_events(panel(spark, sf_dir)).select("variable", "stock", "month")
    return em.lag_to_reports(e.where("variable = 'sales'"), em.report_months(e.where("variable = 'assets'")))


@query("pf8_factor_regression", f"""{PANEL_SQL}, g AS (SELECT month, region, sum(ret * cap_lag) / sum(cap_lag) AS v FROM mon JOIN statics USING (stock) WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2), f AS (SELECT month, avg(ret) AS x1, sum(ret * cap_lag) / sum(cap_lag) AS x2 FROM mon WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1),
 k AS (SELECT region, count(*) AS n, covar_samp(x1, x1) AS aa, covar_samp(x2, x2) AS bb, covar_samp(x1, x2) AS ab, covar_samp(x1, v) AS ay, covar_samp(x2, v) AS yb FROM g JOIN f USING (month) GROUP BY 1)
 SELECT region, n, round((ay * bb - yb * ab) / (aa * bb - ab * ab), 6) AS b1, round((yb * aa - ay * ab) / (aa * bb - ab * ab), 6) AS b2 FROM k""")
def pf8(spark, sf_dir):
    """Each region's return on two factors."""
    m = monthly(spark, sf_dir)
    g = u.portfolios(m.join(statics(spark, sf_dir).select("stock", "region"), "stock"), "month", "region").select("month", "region", F.col("vw").alias("v"))
    f = u.portfolios(m).select("month", F.col("ew").alias("x1"), F.col("vw").alias("x2"))
    return _r(st.grouped_ols2(g.join(f, "month"), "v", "x1", "x2", "region", 12), 6, "b1", "b2").select("region", "n", "b1", "b2")


@query("ap9_window_sums", f"{PANEL_SQL}, s AS (SELECT month, sum(ret * cap_lag) / sum(cap_lag) AS v FROM mon WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1), k AS (SELECT row_number() OVER (ORDER BY month) AS k, v FROM s), w AS (SELECT * FROM (VALUES ('1-3', 1, 3), ('4-6', 4, 6), ('7-12', 7, 12)) t(\"window\", a, b)) SELECT \"window\", round(sum(v), 7) AS total FROM k JOIN w ON k.k BETWEEN a AND b GROUP BY 1")
def ap9(spark, sf_dir):
    """Sums of a series over windows of its steps."""
    k = sr.numbered(u.portfolios(monthly(spark, sf_dir)))
    return _r(sr.window_sums(k, "vw", {"1-3": (1, 3), "4-6": (4, 6), "7-12": (7, 12)}), 7, "total")


@query("src5_merge_items", f"{PANEL_SQL} SELECT stock, date, CASE WHEN day(date) % 2 = 0 THEN close END AS close, CASE WHEN day(date) % 3 = 0 THEN volume END AS volume FROM panel WHERE day(date) % 2 = 0 OR day(date) % 3 = 0")
def src5(spark, sf_dir):
    """Items stacked as long rows meet on (stock, date) in one shuffle; rows without any item are not made."""
    p, day = daily_panel(spark, sf_dir), F.dayofmonth("date")
    long = p.where(day % 2 == 0).select("stock", "date", F.lit("close").alias("item"), F.col("close").alias("value")).union(p.where(day % 3 == 0).select("stock", "date", F.lit("volume"), F.col("volume")))
    return im.merge_items(long, ["close", "volume"])


@query("src20_country_subset", f"{PANEL_SQL} SELECT stock, date, close, country FROM panel JOIN statics USING (stock) WHERE country IN ('NATION_1', 'NATION_5', 'NATION_9')")
def src20(spark, sf_dir):
    """Some countries and columns of the panel."""
    return im.of_countries(daily_panel(spark, sf_dir).select("stock", "date", "close"), statics(spark, sf_dir), ["NATION_1", "NATION_5", "NATION_9"])


@query("src26_market_country", "WITH i AS (SELECT c_custkey AS id, 'INDEX OF ' || n_name AS market, n_name AS word FROM customer JOIN nation ON c_nationkey = n_nationkey), a AS (SELECT n_name AS word, CASE WHEN n_nationkey % 6 = 0 THEN 'ALIAS_' || n_nationkey WHEN n_nationkey % 6 <> 5 THEN n_name END AS country FROM nation WHERE n_nationkey % 6 <> 5) SELECT id, market, country FROM i JOIN a USING (word)")
def src26(spark, sf_dir):
    """Country of each index line by the last word of its name, through aliases; names of no country go."""
    n, k = read(spark, sf_dir, "nation"), F.col("n_nationkey")
    lines = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == k).select(F.col("c_custkey").alias("id"), F.concat(F.lit("INDEX OF "), "n_name").alias("market"))
    aliases = n.where(k % 6 != 5).select(F.col("n_name").alias("word"), F.when(k % 6 == 0, F.concat(F.lit("ALIAS_"), k.cast("string"))).otherwise(F.col("n_name")).alias("country"))
    return im.market_country(lines, aliases).select("id", "market", "country")


@query("dg3_january_growth", f"{LONG_SQL} SELECT variable, year(month) AS year, count(*) AS n, round(median(CASE WHEN value > 0 AND prev > 0 THEN ln(value / prev) END), 7) AS median_growth FROM ch WHERE month(month) = 1 GROUP BY 1, 2")
def dg3(spark, sf_dir):
    """Median log growth of the items at their January updates."""
    return _year(_r(q.january_growth(panel(spark, sf_dir)), 7, "median_growth"))


@query("dg3_values_at_examples", f"{LONG_SQL} SELECT variable, stock, max(value) FILTER (month = DATE '1995-12-31') AS \"1995-12\", max(value) FILTER (month = DATE '1996-01-31') AS \"1996-01\" FROM p WHERE stock IN (2, 5, 7) AND month IN (DATE '1995-12-31', DATE '1996-01-31') GROUP BY 1, 2")
def dg3_values(spark, sf_dir):
    """Values of three firms before and at a January update."""
    return q.values_at(panel(spark, sf_dir), [2, 5, 7], ["1995-12", "1996-01"])


@query("dg5_dropped_variables", "WITH d AS (SELECT o_custkey AS dataset, list_sort(list_distinct(list(o_orderpriority))) AS v FROM orders GROUP BY 1) SELECT dataset, len(list_filter(v, lambda x: x IN ('1-URGENT', '5-LOW'))) AS dropped FROM d WHERE list_has_any(v, ['1-URGENT', '5-LOW'])")
def dg5(spark, sf_dir):
    """Datasets whose list of variables holds one that is to be dropped, and how many."""
    held = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("dataset"), F.col("o_orderpriority").alias("variable"))
    return im.holding_variables(held, ["1-URGENT", "5-LOW"])


@query("pf1_month_grid", f"""{PANEL_SQL}, g AS (SELECT stock, last_day(CAST(unnest(generate_series(date_trunc('month', min(month)), date_trunc('month', max(month)), INTERVAL 1 MONTH)) AS DATE)) AS month FROM uni GROUP BY 1)
 SELECT g.stock, g.month, close, market_cap FROM g LEFT JOIN uni ON uni.stock = g.stock AND uni.month = g.month""")
def pf1(spark, sf_dir):
    """Monthly stock panel without gaps: missing months have rows without values."""
    return u.on_month_grid(universe(spark, sf_dir), "stock", "month", ["close", "market_cap"])


@query("ec8_lag_to_fiscal_year", f"{LONG_SQL}, g AS (SELECT variable, CAST((month(month) - (stock % 4 * 3 + 3) + 12) % 12 AS INT) AS lag, count(*) AS n FROM ch WHERE variable <> 'equity' GROUP BY 1, 2) SELECT *, n / sum(n) OVER (PARTITION BY variable) AS share FROM g")
def ec8(spark, sf_dir):
    """Months from the fiscal year end to the changes of each item."""
    fye = statics(spark, sf_dir).select("stock", (F.col("stock") % 4 * 3 + 3).alias("fye_month"))
    return q.reporting_lag(panel(spark, sf_dir).where("variable <> 'equity'"), fye)
