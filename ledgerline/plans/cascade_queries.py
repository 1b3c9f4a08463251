"""Queries of the whole screening orders, with their reports, on the proxy panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import cascade
from ledgerline.plans.listing_queries import _CORE, CURRENCIES, LINES_SQL, frame, lines, patterns
from ledgerline.plans.registry import query
from ledgerline.sources.proxy import PANEL_SQL, daily_panel, delistings, last_days, read, statics

US = "UNITED STATES"
US_PATTERNS = [(US, " TRUST ", True), (US, " UNITS ", False), (US, "WARRANT", False)]
US_VENUES = [(US, r"LONDON|\(BER\)")]
US_CURRENCIES = [(US, "U$")]
LIMITS = {"one_sign": 0.7, "keep": 3, "history": 400, "zero": 0.2, "run": 2, "high": 0.0375, "low": 0.0348, "up": 0.06, "down": -0.04, "active": 0.15, "gap": 0.06, "penny": 0.1, "after": "1992-06-30", "until": "1998-06-30"}


def us_lines(spark, sf_dir):
    """Lines of the US order: suppliers, some with odd names, codes, currencies and domiciles."""
    k, text = F.col("s_suppkey"), lambda p, x: F.concat(F.lit(p), x.cast("string"))
    name = F.when(k % 13 == 5, " TRUST").when(k % 29 == 6, " UNITS").when(k % 29 == 9, " DEAD - UNITS EXPIRED").when(k % 29 == 10, " (BER)").when(k % 29 == 11, " DEAD - DUPL SEE 3").otherwise("")
    s = read(spark, sf_dir, "supplier").select(
        k.alias("stock"), F.concat("s_name", name).alias("ename"), F.when(k % 23 == 4, "PREF").when(k % 5 == 1, "NA").otherwise("ORD").alias("code"), F.when(k % 10 < 3, text("L", F.floor(k / 2))).alias("loc"), text("I", k).alias("isin"),
        F.when(k % 2 == 0, "P").otherwise("S").alias("isinid"), F.when(k % 31 == 7, "C$").otherwise("U$").alias("currency"), F.when(k % 37 == 8, "CANADA").otherwise(US).alias("country"),
    )
    return s.where(F.col("country") == US)


def us_panel(spark, sf_dir):
    """The proxy panel with what the screens look for: an index of zero, missing prices, flat days and idle days."""
    flat, k = F.col("stock") % 6 == 2, F.col("stock")
    p = daily_panel(spark, sf_dir).drop("market_cap")
    return p.withColumns({
        "return_index": F.when(k % 41 == 12, F.lit(None)).when(F.dayofyear("date") == 77, 0.0).otherwise(F.col("return_index")), "unadj_close": F.when(F.dayofmonth("date") % 13 > 0, F.col("unadj_close") - F.when(k % 7 == 3, 1200).otherwise(0)),
        "high": F.when(flat, 70000.0).otherwise(F.col("high") * F.when(F.dayofyear("date") % 50 == 3, 0.99).otherwise(1.0)), "low": F.when(flat, 1.0).otherwise(F.col("low")), "volume": F.when(flat, F.floor(F.col("volume") / 60) * 1.0).otherwise(F.col("volume")),
    })


def marked(spark, sf_dir):
    s = us_lines(spark, sf_dir)
    verdicts = cascade.first_static_failure(s, frame(spark, US_PATTERNS, "country string, pattern string, overridable boolean"), frame(spark, US_VENUES, "country string, pattern string"), frame(spark, US_CURRENCIES, "country string, currency string"))
    return cascade.us_order(us_panel(spark, sf_dir), s.join(delistings(last_days(spark, sf_dir)), "stock"), verdicts, **LIMITS)


def _stocks(name, source, condition):
    return f"{name} AS (SELECT * FROM {source} WHERE stock NOT IN (SELECT stock FROM {source} GROUP BY stock HAVING {condition}))"


# The order once more, each step on the rows that the one before left: x0 to x24.
US_SQL = f"""{PANEL_SQL}, lines AS (SELECT s_suppkey AS stock, s_name || CASE WHEN s_suppkey % 13 = 5 THEN ' TRUST' WHEN s_suppkey % 29 = 6 THEN ' UNITS' WHEN s_suppkey % 29 = 9 THEN ' DEAD - UNITS EXPIRED' WHEN s_suppkey % 29 = 10 THEN ' (BER)' WHEN s_suppkey % 29 = 11 THEN ' DEAD - DUPL SEE 3' ELSE '' END AS ename,
  CASE WHEN s_suppkey % 23 = 4 THEN 'PREF' WHEN s_suppkey % 5 = 1 THEN 'NA' ELSE 'ORD' END AS code, CASE WHEN s_suppkey % 10 < 3 THEN s_suppkey // 2 END AS loc, s_suppkey % 2 = 0 AS main, CASE WHEN s_suppkey % 31 = 7 THEN 'C$' ELSE 'U$' END AS currency FROM supplier WHERE s_suppkey % 37 <> 8),
 known AS (SELECT lines.*, delisting_date FROM lines JOIN delistings USING (stock)),
 x0 AS (SELECT p.* EXCLUDE (ret, return_index, unadj_close, high, low, volume), CASE WHEN stock % 41 = 12 THEN NULL WHEN dayofyear(date) = 77 THEN 0.0 ELSE return_index END AS return_index, CASE WHEN day(date) % 13 > 0 THEN unadj_close - CASE WHEN stock % 7 = 3 THEN 1200 ELSE 0 END END AS unadj_close,
  CASE WHEN stock % 6 = 2 THEN 70000.0 ELSE high * CASE WHEN dayofyear(date) % 50 = 3 THEN 0.99 ELSE 1.0 END END AS high, CASE WHEN stock % 6 = 2 THEN 1.0 ELSE low END AS low, CASE WHEN stock % 6 = 2 THEN floor(volume / 60) ELSE volume END AS volume, delisting_date FROM panel p LEFT JOIN known USING (stock)),
 x1 AS (SELECT * EXCLUDE (return_index), CASE WHEN return_index >= 1e-6 THEN return_index END AS return_index, CASE WHEN return_index >= 1e-6 THEN return_index END / lag(CASE WHEN return_index >= 1e-6 THEN return_index END) OVER (PARTITION BY stock ORDER BY date) - 1 AS ret FROM x0),
 {_stocks("x2", "x1", "count(return_index) = 0")},
 ok1 AS (SELECT stock FROM known WHERE code IN ('ORD', 'NA') AND NOT contains(ename, ' DUPL') AND NOT (ename LIKE '% UNITS') AND NOT (ename LIKE '% TRUST' AND code <> 'ORD')), x3 AS (SELECT * FROM x2 WHERE stock IN (FROM ok1)),
 x4 AS (SELECT * FROM x3 WHERE stock NOT IN (SELECT stock FROM known WHERE ename LIKE '%(BER)%')),
 x5 AS (SELECT * FROM x4 WHERE stock NOT IN (SELECT stock FROM lines a WHERE NOT main AND loc IN (SELECT loc FROM lines b WHERE main))),
 x6 AS (SELECT * FROM x5), x7 AS (SELECT * FROM x6 WHERE stock IN (SELECT stock FROM known WHERE currency = 'U$')),
 {_stocks("x8", "x7", "avg(CAST(ret > 0 AS INT)) FILTER (ret <> 0) > 0.7 OR 1 - avg(CAST(ret > 0 AS INT)) FILTER (ret <> 0) > 0.7")},
 p1 AS (SELECT *, max(CASE WHEN coalesce(ret, 0) <> 0 THEN date END) OVER (PARTITION BY stock) AS live FROM x8 WHERE delisting_date IS NULL OR date <= delisting_date), p2 AS (SELECT *, sum(CAST(live IS NULL OR date > live AS INT)) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS tail FROM p1),
 x9 AS (SELECT * EXCLUDE (live, tail) FROM p2 WHERE delisting_date IS NULL OR (live IS NOT NULL AND date <= live) OR tail <= 3),
 x10 AS (SELECT * FROM x9 WHERE stock IN (SELECT stock FROM x9 GROUP BY stock HAVING count(*) >= 400 OR date_diff('day', min(date), (SELECT max(date) FROM x9)) < 400)),
 {_stocks("x11", "x10", "avg(CAST(coalesce(ret = 0, false) AS INT)) > 0.2")},
 r1 AS (SELECT *, CAST(return_index IS NULL OR NOT coalesce(return_index = lag(return_index) OVER (PARTITION BY stock ORDER BY date), false) AS INT) AS fresh FROM x11), r2 AS (SELECT *, sum(fresh) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM r1), r3 AS (SELECT *, row_number() OVER (PARTITION BY stock, run ORDER BY date) AS place FROM r2),
 x12 AS (SELECT * EXCLUDE (fresh, run, place) FROM r3 WHERE place <= 2),
 {_stocks("x13", "x12", "stddev_samp(ret) > 0.0375")}, {_stocks("x14", "x13", "stddev_samp(ret) < 0.0348")},
 o1 AS (SELECT *, coalesce((ret > 0.06 AND lead(ret) OVER w < -0.04) OR (ret < -0.04 AND lead(ret) OVER w > 0.06), false) AS pair FROM x14 WINDOW w AS (PARTITION BY stock ORDER BY date)), o2 AS (SELECT *, pair OR coalesce(lag(pair) OVER (PARTITION BY stock ORDER BY date), false) AS bad FROM o1),
 x15 AS (SELECT * EXCLUDE (pair, bad) FROM o2 WHERE NOT bad),
 x16 AS (SELECT * FROM x15 WHERE date IN (SELECT date FROM x15 GROUP BY date HAVING count(*) FILTER (ret <> 0) >= 0.15 * (SELECT count(DISTINCT stock) FROM x15))),
 x17 AS (SELECT * FROM x16 WHERE NOT coalesce(abs(close - unadj_close * adj_factor) / abs(nullif(unadj_close * adj_factor, 0)) > 0.06, false)),
 x18 AS (SELECT * FROM x17 WHERE NOT coalesce(unadj_close <= 0, false)),
 x19 AS (SELECT * FROM x18 WHERE NOT coalesce(high < greatest(open, close, low), false) AND NOT coalesce(low > least(open, close, high), false)),
 t1 AS (SELECT *, coalesce(high = lag(high) OVER w AND low = lag(low) OVER w AND volume = lag(volume) OVER w, false) AS same FROM x19 WINDOW w AS (PARTITION BY stock ORDER BY date)), x20 AS (SELECT * EXCLUDE (same) FROM t1 WHERE NOT same),
 m1 AS (SELECT *, min(CASE WHEN return_index IS NOT NULL AND unadj_close IS NOT NULL THEN date END) OVER (PARTITION BY stock) AS ready FROM x20),
 x21 AS (SELECT * EXCLUDE (ready, unadj_close, return_index), return_index IS NULL OR unadj_close IS NULL AS filled, last_value(return_index IGNORE NULLS) OVER w AS return_index, last_value(unadj_close IGNORE NULLS) OVER w AS unadj_close FROM m1 WHERE date >= ready WINDOW w AS (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING)),
 l1 AS (SELECT *, row_number() OVER (PARTITION BY stock ORDER BY date DESC) = 1 AND delisting_date IS NOT NULL AS delisted FROM x21 WHERE delisting_date IS NULL OR date <= delisting_date),
 x22 AS (SELECT * EXCLUDE (ret, return_index), CASE WHEN delisted THEN (1 + coalesce(ret, 0)) * (1 - 0.35) - 1 ELSE ret END AS ret, CASE WHEN delisted THEN return_index * (1 - 0.35) ELSE return_index END AS return_index FROM l1),
 pm AS (SELECT stock, last_day(date) AS month, arg_max(unadj_close, date) AS v FROM x22 GROUP BY 1, 2), pv AS (SELECT *, lag(v) OVER (PARTITION BY stock ORDER BY month) AS prev FROM pm), pc AS (SELECT pv.month, quantile_cont(prev, 0.1) AS cut FROM x22 JOIN pv ON pv.stock = x22.stock AND pv.month = last_day(x22.date) GROUP BY 1),
 pb AS (SELECT stock, pv.month FROM pv JOIN pc USING (month) WHERE prev < cut), x23 AS (SELECT * FROM x22 WHERE NOT EXISTS (SELECT 1 FROM pb WHERE pb.stock = x22.stock AND pb.month = last_day(x22.date))),
 x24 AS (SELECT * FROM x23 WHERE date > DATE '1992-06-30' AND date <= DATE '1998-06-30')"""


@query("fo9_filter_pipeline", f"{US_SQL} SELECT stock, date, round(ret, 8) AS ret, round(return_index + 1e-9, 6) AS return_index, round(unadj_close + 1e-9, 6) AS unadj_close, filled, delisted FROM x24")
def fo9(spark, sf_dir):
    """The panel that the whole US order leaves."""
    out = cascade.survivors(marked(spark, sf_dir))
    return out.select("stock", "date", F.round("ret", 8).alias("ret"), F.round(F.col("return_index") + 1e-9, 6).alias("return_index"), F.round(F.col("unadj_close") + 1e-9, 6).alias("unadj_close"), "filled", "delisted")


_NAMES = ("all rows", *cascade.US_STEPS)
_LEFT = " UNION ALL ".join(f"SELECT {k} AS step, '{n}' AS name, stock FROM x{k}" for k, n in enumerate(_NAMES))


@query("fx2_filter_report", f"{US_SQL}, g AS (SELECT step, name, country, stock FROM ({_LEFT}) JOIN statics USING (stock)) SELECT step, name, coalesce(country, 'TOTAL') AS country, count(DISTINCT stock) AS stocks, count(*) AS rows FROM g GROUP BY GROUPING SETS ((step, name, country), (step, name))")
def fx2(spark, sf_dir):
    """Stocks and rows left after each step of the US order, by the supplier's nation and in total, from the same marked rows."""
    own = statics(spark, sf_dir).select("stock", F.col("country").alias("nation"))
    return cascade.filter_report(marked(spark, sf_dir).drop("country").join(own, "stock").withColumnRenamed("nation", "country"), cascade.US_STEPS)


@query("fx1_static_cascade", f"""{LINES_SQL}, {_CORE}, f5 AS (SELECT * FROM f3 WHERE (country, currency) IN (('C0', 'X0'), ('C0', 'X1'), ('C1', 'X2'), ('C3', 'X0')))
 SELECT stock, country, CASE WHEN stock NOT IN (SELECT stock FROM f1) THEN 1 WHEN stock NOT IN (SELECT stock FROM f2) THEN 2 WHEN stock NOT IN (SELECT stock FROM f3) THEN 3 WHEN stock NOT IN (SELECT stock FROM f5) THEN 4 END AS gone FROM lines""")
def fx1(spark, sf_dir):
    """Screens 1, 2, 3 and 5 for all countries in one pass: the first that each line fails."""
    venues = frame(spark, [(f"C{k}", r"DELIST\.17") for k in range(5)], "country string, pattern string")
    return cascade.static_cascade(lines(spark, sf_dir), patterns(spark), venues, frame(spark, CURRENCIES, "country string, currency string")).select("stock", "country", "gone")
