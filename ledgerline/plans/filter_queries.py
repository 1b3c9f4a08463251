"""Queries of the daily panel's screens, on the proxy panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import filters as f
from ledgerline.plans.registry import query
from ledgerline.sources.proxy import PANEL_SQL, daily_panel, delistings, statics

KEYS = ("stock", "date", "ret")
UP, DOWN = 0.06, -0.04


def _register(name, screen, sql, columns=KEYS):
    """A screen of the panel, and the SQL of the rows that stay (after the panel's own tables)."""

    def run(spark, sf_dir):
        return screen(daily_panel(spark, sf_dir)).select(*columns)

    query(name, f"{PANEL_SQL}{sql}")(run)


def _stocks(condition):
    return f"SELECT stock, date, ret FROM panel WHERE stock NOT IN (SELECT stock FROM panel GROUP BY stock HAVING {condition})"


_register("r0_returns", lambda p: f.returns_from_index(f.first_wins(p)).withColumn("ret", F.round("ret", 8)), "SELECT stock, date, round(return_index / lag(return_index) OVER (PARTITION BY stock ORDER BY date) - 1, 8) AS ret FROM panel")
_register("f7_implausible_returns", lambda p: f.implausible_returns(p, 0.62), _stocks("avg(CAST(ret > 0 AS INT)) FILTER (ret <> 0) > 0.62 OR 1 - avg(CAST(ret > 0 AS INT)) FILTER (ret <> 0) > 0.62"))
_register("f8_zero_returns", lambda p: f.zero_returns(p, 0.093), _stocks("avg(CAST(ret = 0 AS INT)) > 0.093"))
_register("f9_high_volatility", lambda p: f.high_volatility(p, 0.036), _stocks("stddev_samp(ret) > 0.036"))
_register("f10_low_volatility", lambda p: f.low_volatility(p, 0.0355), _stocks("stddev_samp(ret) < 0.0355"))
_register("f11_without_index", lambda p: f.without_index(p.withColumn("return_index", F.when(F.col("stock") % 7 != 0, F.col("return_index")))), "SELECT stock, date, ret FROM panel WHERE stock % 7 <> 0")
_register("f12_short_history", lambda p: f.short_history(p, 540), "SELECT stock, date, ret FROM panel WHERE stock IN (SELECT stock FROM panel GROUP BY stock HAVING count(*) >= 540 OR date_diff('day', min(date), (SELECT max(date) FROM panel)) < 540)")
_register("f13_padded_tail", lambda p: f.padded_tail(p.withColumn("ret", F.when((F.col("stock") % 2 == 0) & (F.col("date") > "1998-01-01"), 0.0).otherwise(F.col("ret"))), delistings(p), 9), """, z AS (SELECT stock, date, CASE WHEN stock % 2 = 0 AND date > DATE '1998-01-01' THEN 0.0 ELSE ret END AS ret FROM panel),
 k AS (SELECT z.*, d.delisting_date FROM z JOIN delistings d USING (stock) WHERE d.delisting_date IS NULL OR z.date <= d.delisting_date),
 l AS (SELECT *, max(date) FILTER (ret <> 0) OVER (PARTITION BY stock) AS live FROM k),
 t AS (SELECT *, sum(CAST(live IS NULL OR date > live AS INT)) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS pos FROM l)
 SELECT stock, date, ret FROM t WHERE date <= live OR pos <= 9 OR delisting_date IS NULL""")
_register("f14_stale_prices", lambda p: f.stale_prices(p, "return_index", 1), """, c AS (SELECT *, CAST(return_index IS DISTINCT FROM lag(return_index) OVER (PARTITION BY stock ORDER BY date) AS INT) AS ch FROM panel),
 r AS (SELECT *, sum(ch) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM c)
 SELECT stock, date, ret FROM (SELECT *, row_number() OVER (PARTITION BY stock, run ORDER BY date) AS pos FROM r) WHERE pos <= 1""")
_PAIRS = f""", a AS (SELECT *, coalesce((ret > {UP} AND lead(ret) OVER w < {DOWN}) OR (ret < {DOWN} AND lead(ret) OVER w > {UP}), false) AS pair FROM panel WINDOW w AS (PARTITION BY stock ORDER BY date)),
 b AS (SELECT *, pair OR coalesce(lag(pair) OVER (PARTITION BY stock ORDER BY date), false) AS bad FROM a)"""
_register("f15_outlier_pairs", lambda p: f.outlier_pairs(p, UP, DOWN), f"{_PAIRS} SELECT stock, date, ret FROM b WHERE NOT bad")
_register("f15_outlier_pairs_zero", lambda p: f.outlier_pairs(p, UP, DOWN, "zero"), f"{_PAIRS} SELECT stock, date, CASE WHEN bad THEN 0.0 ELSE ret END AS ret FROM b")
_register("f16_holidays", lambda p: f.holidays(p, 0.2), "SELECT stock, date, ret FROM panel WHERE date IN (SELECT date FROM panel GROUP BY date HAVING count(*) FILTER (ret <> 0) >= 0.2 * (SELECT count(DISTINCT stock) FROM panel))")
_register("f18_adjustment_gaps", lambda p: f.adjustment_gaps(p, 0.05), "SELECT stock, date, ret FROM panel WHERE NOT abs(close - unadj_close * adj_factor) / (unadj_close * adj_factor) > 0.05")
_register("f19_nonsense", lambda p: f.nonsense_prices(p.withColumn("unadj_close", F.col("unadj_close") - 1200)), "SELECT stock, date, ret FROM panel WHERE NOT unadj_close - 1200 <= 0")
_register("f21_penny_stocks", lambda p: f.penny_stocks(p, 0.25), """, l AS (SELECT stock, last_day(date) AS month, arg_max(unadj_close, date) AS px FROM panel GROUP BY 1, 2),
 v AS (SELECT *, lag(px) OVER (PARTITION BY stock ORDER BY month) AS prev FROM l),
 c AS (SELECT v.month, quantile_cont(v.prev, 0.25) AS cut FROM panel p JOIN v ON p.stock = v.stock AND last_day(p.date) = v.month GROUP BY 1)
 SELECT p.stock, p.date, p.ret FROM panel p JOIN v ON p.stock = v.stock AND last_day(p.date) = v.month JOIN c ON c.month = v.month WHERE NOT coalesce(v.prev < c.cut, false)""")
_register("fo1_implausible_prices", lambda p: f.implausible_prices(p.withColumn("high", F.col("high") * F.when(F.col("stock") % 5 == 0, 0.999).otherwise(1.0))), "SELECT stock, date, ret FROM (SELECT *, high * CASE WHEN stock % 5 = 0 THEN 0.999 ELSE 1.0 END AS h FROM panel) WHERE NOT (h < greatest(open, close, low)) AND NOT (low > least(open, close, h))")
_register("fo2_extreme_prices", lambda p: f.extreme_prices(p, 20000), "SELECT stock, date, ret FROM panel WHERE NOT greatest(open, high, low, close) > 20000")
_register("fo3_decimal_errors", lambda p: f.decimal_errors(p, 0.08, -0.06), "SELECT stock, date, ret FROM panel WHERE ret BETWEEN -0.06 AND 0.08")
_register("fo4_no_trading", lambda p: f.no_trading(p.withColumns({c: F.floor(F.col(c) / k) for c, k in (("high", 20000), ("low", 20000), ("volume", 25))})), """, g AS (SELECT stock, date, ret, floor(high / 20000) AS h, floor(low / 20000) AS l, floor(volume / 25) AS v FROM panel)
 SELECT stock, date, ret FROM (SELECT *, coalesce(h = lag(h) OVER w AND l = lag(l) OVER w AND v = lag(v) OVER w, false) AS same FROM g WINDOW w AS (PARTITION BY stock ORDER BY date)) WHERE NOT same""")
_register("fo5_extreme_returns", lambda p: f.extreme_returns(p, 0.05, 0.95), ", q AS (SELECT date, quantile_cont(ret, 0.05) AS a, quantile_cont(ret, 0.95) AS b FROM panel GROUP BY 1) SELECT stock, date, ret FROM panel JOIN q USING (date) WHERE ret BETWEEN a AND b")
_register("fo6_extreme_returns_by_deviation", lambda p: f.extreme_returns_by_deviation(p, 1.6), ", q AS (SELECT date, median(ret) AS m, stddev_samp(ret) AS s FROM panel GROUP BY 1) SELECT stock, date, ret FROM panel JOIN q USING (date) WHERE NOT coalesce(abs(ret - m) > 1.6 * s, false)")
def _gaps():
    return {"open": F.when(F.col("stock") % 4 != F.month("date") % 4, F.col("open")), "close": F.when(F.dayofmonth("date") % 5 != 0, F.col("close"))}



_register("fo7_handle_missing", lambda p: f.handle_missing(p.withColumns(_gaps()), ["open", "close"], ["open", "close"]), """, g AS (SELECT stock, date, ret, CASE WHEN stock % 4 <> month(date) % 4 THEN open END AS open, CASE WHEN day(date) % 5 <> 0 THEN close END AS close FROM panel),
 r AS (SELECT *, min(date) FILTER (open IS NOT NULL AND close IS NOT NULL) OVER (PARTITION BY stock) AS ready FROM g)
 SELECT stock, date, ret, open IS NULL OR close IS NULL AS filled, last_value(open IGNORE NULLS) OVER w AS open, last_value(close IGNORE NULLS) OVER w AS close
 FROM r WHERE date >= ready WINDOW w AS (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING)""", ("stock", "date", "ret", "filled", "open", "close"))
_register("adj1_delisting_return", lambda p: f.delisting_return(p, delistings(p)).withColumns({"ret": F.round("ret", 7), "return_index": F.round("return_index", 7)}), """, k AS (SELECT p.stock, p.date, p.ret, p.return_index, delisting_date FROM panel p LEFT JOIN delistings d USING (stock) WHERE delisting_date IS NULL OR p.date <= delisting_date),
 l AS (SELECT *, delisting_date IS NOT NULL AND row_number() OVER (PARTITION BY stock ORDER BY date DESC) = 1 AS delisted FROM k)
 SELECT stock, date, round(CASE WHEN delisted THEN (1 + coalesce(ret, 0)) * 0.65 - 1 ELSE ret END, 7) AS ret, round(CASE WHEN delisted THEN return_index * 0.65 ELSE return_index END, 7) AS return_index, delisted FROM l""", ("stock", "date", "ret", "return_index", "delisted"))
_register("adj2_scale_flagged", lambda p: f.scale_flagged(f.delisting_return(p, delistings(p)), "market_cap", -0.35).withColumn("market_cap", F.round("market_cap", 6)), """, k AS (SELECT p.stock, p.date, p.market_cap AS c, delisting_date FROM panel p LEFT JOIN delistings d USING (stock) WHERE delisting_date IS NULL OR p.date <= delisting_date),
 l AS (SELECT *, delisting_date IS NOT NULL AND row_number() OVER (PARTITION BY stock ORDER BY date DESC) = 1 AS delisted FROM k)
 SELECT stock, date, round(CASE WHEN delisted THEN c * 0.65 ELSE c END, 6) AS market_cap FROM l""", ("stock", "date", "market_cap"))
_register("adj3_undo_delisting", lambda p: f.scale_flagged(f.delisting_return(p, delistings(p)), "return_index", -0.35, undo=True).withColumn("return_index", F.round("return_index", 4)), "SELECT p.stock, p.date, round(p.return_index, 4) AS return_index FROM panel p LEFT JOIN delistings d USING (stock) WHERE delisting_date IS NULL OR p.date <= delisting_date", ("stock", "date", "return_index"))
_register("adj5_period", lambda p: f.period(p, "1994-12-31", "1997-06-30"), "SELECT stock, date, ret FROM panel WHERE date > DATE '1994-12-31' AND date <= DATE '1997-06-30'")


@query("fo8_null_profile", f"""{PANEL_SQL}, g AS (SELECT CASE WHEN stock % 4 <> month(date) % 4 THEN open END AS open, CASE WHEN day(date) % 5 <> 0 THEN close END AS close, volume FROM panel),
 c AS (SELECT 'open' AS "column", count(*) FILTER (open IS NULL) AS nulls, count(*) AS n FROM g UNION ALL SELECT 'close', count(*) FILTER (close IS NULL), count(*) FROM g)
 SELECT "column", nulls, nulls / n AS share FROM c WHERE nulls > 0""")
def fo8(spark, sf_dir):
    return f.null_profile(daily_panel(spark, sf_dir).withColumns(_gaps()).select("open", "close", "volume"))


@query("f17_survivorship", f"{PANEL_SQL} SELECT p.stock, p.date, p.ret FROM panel p JOIN statics s USING (stock) WHERE region <> 'ASIA' AND p.date >= make_date(CAST(1992 + company % 5 AS INT), 1, 1)")
def f17(spark, sf_dir):
    s = statics(spark, sf_dir)
    starts = s.where("region <> 'ASIA'").select("country", F.make_date(1992 + F.col("company") % 5, F.lit(1), F.lit(1)).alias("start")).distinct()
    return f.survivorship(daily_panel(spark, sf_dir), s, starts).select(*KEYS)
