"""Queries of the quality battery, the emission tables and the statistics, on the proxy panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import checks as q
from ledgerline.operators import emissions as em
from ledgerline.operators import pit
from ledgerline.operators import statistics as st
from ledgerline.operators import universe as u
from ledgerline.plans.pit_queries import ITEMS, WIDE_SQL, annual_wide, attached
from ledgerline.plans.registry import query
from ledgerline.plans.universe_queries import monthly, universe
from ledgerline.sources.proxy import PANEL_SQL, daily_panel, statics

LONG_SQL = WIDE_SQL + """, lng AS (SELECT stock, month, unnest(['sales', 'assets', 'equity']) AS variable, unnest([sales, assets, equity]) AS value FROM wide),
p AS (SELECT * FROM lng WHERE value IS NOT NULL),
lg AS (SELECT *, lag(value) OVER (PARTITION BY variable, stock ORDER BY month) AS prev FROM p),
ch AS (SELECT * FROM lg WHERE prev IS NOT NULL AND value <> prev)
"""


def panel(spark, sf_dir):
    return pit.long_form(annual_wide(spark, sf_dir), ITEMS)


def _r(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _year(df):
    return df.withColumn("year", F.col("year").cast("long"))


@query("qc1_prepare", """WITH o AS (SELECT o_custkey AS stock, last_day(CAST(o_orderdate AS DATE)) AS month, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders)
 SELECT 'price' AS variable, stock, month, value FROM (SELECT *, row_number() OVER (PARTITION BY stock, month ORDER BY date DESC, value) AS r FROM o) WHERE r = 1""")
def qc1(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return q.prepare(o.select(F.lit("price").alias("variable"), F.col("o_custkey").alias("stock"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("value"))).select("variable", "stock", "month", "value")


@query("qc2_change_events", f"{LONG_SQL} SELECT variable, stock, month, value, prev FROM ch")
def qc2(spark, sf_dir):
    return q.change_events(panel(spark, sf_dir)).select("variable", "stock", "month", "value", "prev")


@query("qc3_firm_years", f"{LONG_SQL} SELECT variable, stock, year(month) AS year, arg_max(value, month) AS value FROM p GROUP BY 1, 2, 3")
def qc3(spark, sf_dir):
    return _year(q.firm_years(panel(spark, sf_dir)))


@query("qc4_in_universe", f"{LONG_SQL} SELECT variable, stock, month, value FROM p WHERE EXISTS (SELECT 1 FROM uni WHERE uni.stock = p.stock AND uni.month = p.month)")
def qc4(spark, sf_dir):
    return q.in_universe(panel(spark, sf_dir), universe(spark, sf_dir)).select("variable", "stock", "month", "value")


_CV = """cv AS (SELECT v.variable, u.month, count(*) AS n, count(p.stock) AS n_value, sum(market_cap) AS cap, coalesce(sum(market_cap) FILTER (p.stock IS NOT NULL), 0) AS cap_value, (SELECT count(*) FROM p o WHERE o.variable = v.variable AND o.month = u.month AND NOT EXISTS (SELECT 1 FROM un x WHERE x.stock = o.stock AND x.month = o.month)) AS n_outside
 FROM un u CROSS JOIN (SELECT DISTINCT variable FROM p) v LEFT JOIN p ON p.variable = v.variable AND p.stock = u.stock AND p.month = u.month GROUP BY 1, 2)"""
#: A universe in which a quarter of the stocks is missing for some years, so that values stand outside it.
_UN = "un AS (SELECT * FROM uni WHERE stock % 4 > 0 OR year(month) BETWEEN 1994 AND 1996)"


def part_universe(spark, sf_dir):
    return universe(spark, sf_dir).where("stock % 4 > 0 or year(month) between 1994 and 1996")


@query("qc5_coverage_by_month", f"{LONG_SQL}, {_UN}, {_CV} SELECT variable, month, n, n_value, round(cap, 2) AS cap, round(cap_value, 2) AS cap_value, n_value / n AS ew, round(cap_value / cap, 9) AS vw, n_outside FROM cv")
def qc5(spark, sf_dir):
    return _r(_r(q.coverage_by_month(panel(spark, sf_dir), part_universe(spark, sf_dir)), 9, "vw"), 2, "cap", "cap_value")


_FY = "fyr AS (SELECT variable, stock, year(month) AS year, arg_max(value, month) AS value FROM p GROUP BY 1, 2, 3)"


@query("qc7_overview", f"""{LONG_SQL}, {_UN}, {_CV}, {_FY}, c AS (SELECT variable, year, quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM fyr GROUP BY 1, 2), lv AS (SELECT variable, year, avg(value) AS mean, median(value) AS median, avg(value) FILTER (value BETWEEN a AND b) AS trimmed FROM fyr JOIN c USING (variable, year) GROUP BY 1, 2),
 rw AS (SELECT variable, year(month) AS year, count(DISTINCT stock) AS firms, count(*) AS n FROM p GROUP BY 1, 2), cy AS (SELECT variable, year(month) AS year, avg(n_value / n) AS ew, avg(cap_value / cap) AS vw FROM cv GROUP BY 1, 2)
 SELECT variable, year, firms, n, n / firms AS months_per_firm, round(mean, 2) AS mean, round(median, 4) AS median, round(trimmed, 2) AS trimmed, round(ew, 9) AS ew, round(vw, 9) AS vw FROM rw JOIN lv USING (variable, year) LEFT JOIN cy USING (variable, year)""")
def qc7(spark, sf_dir):
    """The year's firms and firm-months, levels of its firm-years, and its mean coverage."""
    p = panel(spark, sf_dir)
    return _year(_r(_r(_r(q.yearly_overview(p, q.coverage_by_month(p, part_universe(spark, sf_dir))), 2, "mean", "trimmed"), 4, "median"), 9, "ew", "vw"))


@query("qc8_history", f"{LONG_SQL}, f AS (SELECT variable, stock, count(*) AS n, date_diff('month', min(month), max(month)) + 1 AS span FROM p GROUP BY 1, 2) SELECT variable, count(*) AS firms, CAST(sum(n) AS BIGINT) AS obs, CAST(sum(span) AS BIGINT) AS months, count(*) FILTER (span > n) AS firms_with_gaps FROM f GROUP BY 1")
def qc8(spark, sf_dir):
    return q.history(panel(spark, sf_dir))


@query("qc9_matching", f"{LONG_SQL}, a AS (SELECT DISTINCT stock FROM p WHERE variable = 'equity' AND value > 1e6), b AS (SELECT DISTINCT stock FROM uni WHERE n_days > 10) SELECT count(*) FILTER (a.stock IS NOT NULL AND b.stock IS NOT NULL) AS matched, count(*) FILTER (b.stock IS NULL) AS only_variable, count(*) FILTER (a.stock IS NULL) AS only_universe FROM a FULL JOIN b ON a.stock = b.stock")
def qc9(spark, sf_dir):
    a = panel(spark, sf_dir).where("variable = 'equity' and value > 1e6").select("stock").distinct().withColumn("a", F.lit(1))
    b = universe(spark, sf_dir).where("n_days > 10").select("stock").distinct().withColumn("b", F.lit(1))
    return a.join(b, "stock", "full").agg(F.count_if(F.expr("a = 1 and b = 1")).alias("matched"), F.count_if(F.col("b").isNull()).alias("only_variable"), F.count_if(F.col("a").isNull()).alias("only_universe"))


@query("qc10_update_frequency", f"""{LONG_SQL}, y AS (SELECT variable, stock, year(month) AS year, count(*) AS n FROM p GROUP BY 1, 2, 3 HAVING count(*) >= 12), c AS (SELECT variable, stock, year(month) AS year, count(*) AS k FROM ch GROUP BY 1, 2, 3), j AS (SELECT y.*, coalesce(k, 0) AS k FROM y LEFT JOIN c USING (variable, stock, year))
 SELECT variable, year, count(*) AS firm_years, avg(CAST(k = 0 AS INT)) AS none, avg(CAST(k = 1 AS INT)) AS one, avg(CAST(k BETWEEN 2 AND 3 AS INT)) AS two_three, avg(CAST(k = 4 AS INT)) AS four, avg(CAST(k >= 5 AS INT)) AS more, median(k) AS median FROM j GROUP BY 1, 2""")
def qc10(spark, sf_dir):
    return _year(q.update_frequency(panel(spark, sf_dir)))


@query("qc11_reporting_lag", f"{LONG_SQL}, g AS (SELECT variable, CAST((month(month) - (stock % 12 + 1) + 12) % 12 AS INT) AS lag, count(*) AS n FROM ch GROUP BY 1, 2) SELECT *, n / sum(n) OVER (PARTITION BY variable) AS share FROM g")
def qc11(spark, sf_dir):
    fye = statics(spark, sf_dir).select("stock", (F.col("stock") % 12 + 1).alias("fye_month"))
    return q.reporting_lag(panel(spark, sf_dir), fye)


@query("qc12_stale_runs", f"""{LONG_SQL}, r AS (SELECT *, sum(CAST(prev IS NULL OR value <> prev AS INT)) OVER (PARTITION BY variable, stock ORDER BY month ROWS UNBOUNDED PRECEDING) AS run FROM lg), g AS (SELECT variable, stock, run, count(*) AS n, any_value(value) AS value FROM r GROUP BY 1, 2, 3 HAVING count(*) > 11)
 SELECT variable, count(DISTINCT stock) FILTER (value <> 0) AS firms_stale, count(DISTINCT stock) FILTER (value = 0) AS firms_zero, max(n) AS longest FROM g GROUP BY 1""")
def qc12(spark, sf_dir):
    return q.stale_runs(panel(spark, sf_dir), 11)


JUMP_SQL = LONG_SQL + """, pl AS (SELECT *, lag(value) OVER (PARTITION BY variable, stock ORDER BY month) AS pv FROM p), e AS (SELECT *, log10(value / pv) AS step FROM pl WHERE pv > 0 AND value > 0 AND value <> pv),
e1 AS (SELECT *, coalesce(abs(step) >= 0.9 AND abs(lead(step) OVER w + step) <= 0.3 AND date_diff('month', month, lead(month) OVER w) <= 24, false) AS reversed FROM e WINDOW w AS (PARTITION BY variable, stock ORDER BY month)),
j AS (SELECT * FROM (SELECT *, coalesce(lag(reversed) OVER (PARTITION BY variable, stock ORDER BY month), false) AS undoes FROM e1) WHERE (abs(step) >= 2.5 OR reversed) AND NOT undoes)
"""


@query("qc13_unit_jumps", f"{JUMP_SQL} SELECT variable, stock, month, round(step, 7) AS step, CASE WHEN reversed THEN 'reversal' ELSE 'jump' END AS type FROM j")
def qc13(spark, sf_dir):
    return _r(q.unit_jumps(panel(spark, sf_dir)), 7, "step").select("variable", "stock", "month", "step", "type")


@query("qc14_unit_error_candidates", f"""{JUMP_SQL}, jj AS (SELECT variable || k AS variable, stock, month, step FROM j CROSS JOIN (SELECT unnest(['', '_a', '_b']) AS k) WHERE NOT (k = '_b' AND stock % 2 = 0)), g AS (SELECT stock, month, count(DISTINCT variable) AS n, string_agg(DISTINCT variable, ',' ORDER BY variable) AS variables, median(abs(step)) AS size, max(step) - min(step) AS spread FROM jj GROUP BY 1, 2 HAVING count(DISTINCT variable) >= 2)
 SELECT stock, month, n, variables, round(size, 7) AS size, n >= 3 AND spread <= 0.15 AND least(abs(size - 3), abs(size - 6)) <= 0.2 AS error FROM g""")
def qc14(spark, sf_dir):
    """Jumps of one item stand for three items of the same firm, the third one in every other firm."""
    j = q.unit_jumps(panel(spark, sf_dir)).withColumn("k", F.explode(F.array(F.lit(""), F.lit("_a"), F.lit("_b")))).where("not (k = '_b' and stock % 2 = 0)")
    return _r(q.unit_error_candidates(j.withColumn("variable", F.concat("variable", "k"))), 7, "size").drop("spread")


_SEVEN = (1, 5, 25, 50, 75, 95, 99)


@query("qc16_quantiles", f"{LONG_SQL}, {_FY} SELECT variable, year, count(*) AS n, " + ", ".join(f"round(quantile_cont(value, {x / 100}) + 3e-7, 5) AS p{x}" for x in _SEVEN) + " FROM fyr GROUP BY 1, 2")
def qc16(spark, sf_dir):
    out = q.yearly_quantiles(panel(spark, sf_dir))
    return _year(out.withColumns({f"p{x}": F.round(F.col(f"p{x}") + 3e-7, 5) for x in _SEVEN}))  # off rounding ties


@query("qc17_implausible", f"""{LONG_SQL}, x AS (SELECT *, CASE WHEN value > 0 THEN log10(value) END AS x FROM p), m AS (SELECT variable, median(x) AS m FROM x GROUP BY 1), d AS (SELECT x.variable, median(abs(x - m)) AS s FROM x JOIN m USING (variable) GROUP BY 1)
 SELECT variable, count(*) AS n, avg(CAST(value = 0 AS INT)) AS zero, avg(CAST(value < 0 AS INT)) AS negative, count(*) FILTER (s > 1e-9 AND abs((x - m) / (1.4826 * s)) > 5) AS extreme FROM x JOIN m USING (variable) JOIN d USING (variable) GROUP BY 1""")
def qc17(spark, sf_dir):
    return q.robust_extremes(panel(spark, sf_dir))


@query("qc18_december_panel", f"{WIDE_SQL} SELECT u.stock, u.month, market_cap, sales, assets FROM uni u JOIN wide w ON w.stock = u.stock AND w.month = u.month WHERE month(u.month) = 12")
def qc18(spark, sf_dir):
    return q.december_panel(annual_wide(spark, sf_dir), universe(spark, sf_dir)).select("stock", "month", "market_cap", "sales", "assets")


@query("qc20_update_alignment", f"""{LONG_SQL}, c AS (SELECT variable, stock, year(month) AS year, max(month) AS month FROM ch GROUP BY 1, 2, 3 HAVING count(*) = 1)
 SELECT a.variable, b.variable AS other, count(*) AS n, avg(CAST(a.month = b.month AS INT)) AS same FROM c a JOIN c b ON a.stock = b.stock AND a.year = b.year AND a.variable < b.variable GROUP BY 1, 2 HAVING count(*) >= 20""")
def qc20(spark, sf_dir):
    return q.update_alignment(panel(spark, sf_dir), 20)


@query("ec5_report_months", f"{LONG_SQL} SELECT DISTINCT stock, month FROM ch")
def ec5(spark, sf_dir):
    return em.report_months(q.change_events(panel(spark, sf_dir)))


@query("ec6_change_months", f"{LONG_SQL} SELECT variable, " + ", ".join(f"count(*) FILTER (month(month) = {k}) / count(*) AS m{k}" for k in range(1, 13)) + " FROM ch GROUP BY 1")
def ec6(spark, sf_dir):
    return q.change_months(panel(spark, sf_dir))


@query("ec9_new_values", f"{LONG_SQL} SELECT variable, year(month) AS year, count(*) AS n FROM lg WHERE prev IS NULL OR value <> prev GROUP BY 1, 2")
def ec9(spark, sf_dir):
    return _year(q.first_rows_and_changes(panel(spark, sf_dir)))


@query("ec10_scope_identity", f"{WIDE_SQL} SELECT year(month) AS year, count(*) AS n, round(median(sales / (equity + assets * 0.55)), 7) AS median_ratio, avg(CAST(abs(sales / (equity + assets * 0.55) - 1) <= 0.02 AS INT)) AS within FROM wide WHERE sales > 0 AND equity IS NOT NULL GROUP BY 1")
def ec10(spark, sf_dir):
    return _year(_r(em.identity_by_year(annual_wide(spark, sf_dir), "sales", F.col("equity") + F.col("assets") * 0.55, 0.02), 7, "median_ratio"))


@query("ec12_change_alignment", f"""{LONG_SQL} SELECT c.variable, p.variable AS other, count(*) AS n, avg(CAST(h.stock IS NOT NULL AS INT)) AS share FROM ch c JOIN p ON p.stock = c.stock AND p.month = c.month AND p.variable <> c.variable LEFT JOIN ch h ON h.variable = p.variable AND h.stock = c.stock AND h.month = c.month GROUP BY 1, 2 HAVING count(*) >= 50""")
def ec12(spark, sf_dir):
    return q.change_alignment(panel(spark, sf_dir))


@query("ec13_share_classes", f"""{WIDE_SQL}, x AS (SELECT company, month, count(*) AS lines, count(sales) AS known, count(DISTINCT sales) AS kinds FROM wide JOIN statics USING (stock) GROUP BY 1, 2 HAVING count(*) > 1)
 SELECT count(*) AS groups, avg(CAST(kinds = 1 AND known = lines AS INT)) AS identical, avg(CAST(known BETWEEN 1 AND lines - 1 AS INT)) AS partly FROM x""")
def ec13(spark, sf_dir):
    return em.share_classes(annual_wide(spark, sf_dir), statics(spark, sf_dir), "sales")


@query("der5_characteristics", f"""{WIDE_SQL}, x AS (SELECT a.*, CASE WHEN date_diff('month', month, lead(month) OVER w) = 1 THEN lead(ret) OVER w END AS ret_next, CASE WHEN date_diff('month', lag(month) OVER w, month) = 1 THEN lag(market_cap) OVER w END AS me_lag,
  CASE WHEN count(ret) OVER m = 11 THEN exp(sum(ln(1 + ret)) OVER m) - 1 END AS mom FROM att a WINDOW w AS (PARTITION BY stock ORDER BY month), m AS (PARTITION BY stock ORDER BY month ROWS BETWEEN 11 PRECEDING AND 1 PRECEDING))
 SELECT stock, month, ret_next, me_lag, round(mom, 7) AS mom_12_2, round(CASE WHEN equity > 0 THEN ln(equity / market_cap) END, 7) AS log_bm FROM x""")
def der5(spark, sf_dir):
    return _r(st.characteristics(attached(spark, sf_dir)), 7, "mom_12_2", "log_bm").select("stock", "month", "ret_next", "me_lag", "mom_12_2", "log_bm")


@query("ap1_winsorize", f"{PANEL_SQL}, c AS (SELECT month, quantile_cont(ret, 0.05) AS a, quantile_cont(ret, 0.95) AS b FROM mon GROUP BY 1) SELECT stock, month, round(CASE WHEN ret IS NOT NULL THEN least(greatest(ret, a), b) END + 1e-12, 8) AS ret FROM mon JOIN c USING (month)")
def ap1(spark, sf_dir):
    return _r(st.winsorize(monthly(spark, sf_dir), ["ret"], 0.05).withColumn("ret", F.col("ret") + 1e-12), 8, "ret").select("stock", "month", "ret")


OLS_SQL = WIDE_SQL + """, z AS (SELECT a.stock, a.month, lead(ret) OVER (PARTITION BY stock ORDER BY month) AS y, ln(market_cap) AS x1, ret AS x2 FROM att a),
g AS (SELECT month, count(*) AS n, avg(y) AS y, avg(x1) AS a, avg(x2) AS b, covar_samp(x1, x1) AS aa, covar_samp(x2, x2) AS bb, covar_samp(x1, x2) AS ab, covar_samp(x1, y) AS ay, covar_samp(x2, y) AS bby, covar_samp(y, y) AS yy FROM z WHERE y IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL GROUP BY 1 HAVING count(*) >= 50),
o AS (SELECT month, n, (ay * bb - bby * ab) / (aa * bb - ab * ab) AS b1, (bby * aa - ay * ab) / (aa * bb - ab * ab) AS b2, y, a, b, ay, bby, yy FROM g)
"""


def _ols(spark, sf_dir):
    z = attached(spark, sf_dir).withColumns({"y": F.lead("ret").over(pit.by_month()), "x1": F.log("market_cap"), "x2": F.col("ret")})
    return st.grouped_ols2(z, "y", "x1", "x2", "month", 50)


@query("stat1_grouped_ols", f"{OLS_SQL} SELECT month, n, round(y - b1 * a - b2 * b, 7) AS b0, round(b1, 7) AS b1, round(b2, 7) AS b2, round((b1 * ay + b2 * bby) / yy, 7) AS r2 FROM o")
def stat1(spark, sf_dir):
    return _r(_ols(spark, sf_dir), 7, "b0", "b1", "b2", "r2")


HAC_SQL = """, u AS (SELECT series, ord, v, v - avg(v) OVER (PARTITION BY series) AS u FROM src WHERE v IS NOT NULL), l AS (SELECT series, v, u * u AS s0, u * lag(u, 1) OVER w AS s1, u * lag(u, 2) OVER w AS s2, u * lag(u, 3) OVER w AS s3 FROM u WINDOW w AS (PARTITION BY series ORDER BY ord)),
h AS (SELECT series, count(*) AS n, avg(v) AS mean, sqrt(greatest(sum(s0) + 1.5 * coalesce(sum(s1), 0) + coalesce(sum(s2), 0) + 0.5 * coalesce(sum(s3), 0), 0)) / count(*) AS se FROM l GROUP BY 1)
SELECT series, n, round(mean, 7) AS mean, round(se, 7) AS se, round(mean / se, 4) AS t FROM h"""


@query("stat2_hac_mean", f"{PANEL_SQL}, src AS (SELECT country AS series, month AS ord, sum(ret * cap_lag) / sum(cap_lag) AS v FROM mon JOIN statics USING (stock) WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2){HAC_SQL}")
def stat2(spark, sf_dir):
    m = u.portfolios(monthly(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "country"), "stock"), "month", "country")
    return _r(_r(st.hac_mean(m.withColumnRenamed("country", "series"), "series", "month", "vw", 3), 7, "mean", "se"), 4, "t")


@query("ap2_fama_macbeth", f"{OLS_SQL}, src AS (SELECT 'b1' AS series, month AS ord, b1 AS v FROM o UNION ALL SELECT 'b2', month, b2 FROM o){HAC_SQL}")
def ap2(spark, sf_dir):
    """Monthly cross-sectional regressions, then the mean of each coefficient with its long-run t."""
    b = _ols(spark, sf_dir).unpivot("month", ["b1", "b2"], "series", "v")
    return _r(_r(st.hac_mean(b, "series", "month", "v", 3), 7, "mean", "se"), 4, "t")


SORT_SQL = WIDE_SQL + """, d0 AS (SELECT stock, month, ret, lag(ret) OVER (PARTITION BY stock ORDER BY month) AS chr, lag(market_cap) OVER (PARTITION BY stock ORDER BY month) AS w FROM att),
d1 AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY chr, stock) AS r, count(*) OVER (PARTITION BY month) AS n FROM d0 WHERE chr IS NOT NULL AND ret IS NOT NULL AND w > 0),
d2 AS (SELECT *, CAST(greatest(1, ((r - 1) * 10 + n - 2) // (n - 1)) AS INT) AS bin FROM d1 WHERE n >= 20), d3 AS (SELECT month, bin, count(*) AS n, avg(ret) AS ew, sum(ret * w) / sum(w) AS vw FROM d2 GROUP BY 1, 2)
"""


def _sorts(spark, sf_dir):
    d = attached(spark, sf_dir).withColumns({"chr": F.lag("ret").over(pit.by_month()), "w": F.lag("market_cap").over(pit.by_month())})
    return st.sorts(d, "chr", "ret", "w")


@query("ap3_decile_sorts", f"{SORT_SQL} SELECT month, bin, n, round(ew + 1e-12, 8) AS ew, round(vw, 8) AS vw FROM d3")
def ap3(spark, sf_dir):
    return _r(_sorts(spark, sf_dir).withColumn("ew", F.col("ew") + 1e-12), 8, "ew", "vw")


@query("ap3_spread", f"{SORT_SQL}, src AS (SELECT 'spread' AS series, month AS ord, max(ew) FILTER (bin = 10) - max(ew) FILTER (bin = 1) AS v FROM d3 GROUP BY 2){HAC_SQL}")
def ap3s(spark, sf_dir):
    s = st.spread(_sorts(spark, sf_dir), 10).withColumn("series", F.lit("spread"))
    return _r(_r(st.hac_mean(s, "series", "month", "spread", 3), 7, "mean", "se"), 4, "t")


JUNE_SQL = WIDE_SQL + """, f0 AS (SELECT stock, year(month) AS formation, market_cap, equity / market_cap AS bm FROM att WHERE month(month) = 6),
c AS (SELECT formation, quantile_cont(market_cap, 0.5) AS m, quantile_cont(bm, 0.3) AS a, quantile_cont(bm, 0.7) AS b FROM f0 WHERE stock % 2 = 0 AND bm IS NOT NULL GROUP BY 1 HAVING count(*) >= 10),
js AS (SELECT stock, formation, CASE WHEN market_cap <= m THEN 'S' ELSE 'B' END || CASE WHEN bm <= a THEN 'L' WHEN bm <= b THEN 'M' ELSE 'H' END AS cell FROM f0 JOIN c USING (formation) WHERE bm IS NOT NULL)
"""


def _june(spark, sf_dir):
    f0 = attached(spark, sf_dir).where(F.month("month") == 6).select("stock", F.year("month").cast("long").alias("formation"), "market_cap", F.try_divide("equity", "market_cap").alias("bm"))
    return st.june_sorts(f0, F.col("stock") % 2 == 0, "bm", 10)


@query("ap4_june_sorts", f"{JUNE_SQL} SELECT * FROM js")
def ap4(spark, sf_dir):
    return _june(spark, sf_dir).select("stock", "formation", "cell")


@query("ap5_factors", f"""{JUNE_SQL}, r AS (SELECT m.month, cell, sum(ret * cap_lag) / sum(cap_lag) AS v FROM mon m JOIN js ON js.stock = m.stock AND js.formation = year(m.month) - CASE WHEN month(m.month) <= 6 THEN 1 ELSE 0 END WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2),
 w AS (SELECT month, max(v) FILTER (cell = 'SL') AS sl, max(v) FILTER (cell = 'SM') AS sm, max(v) FILTER (cell = 'SH') AS sh, max(v) FILTER (cell = 'BL') AS bl, max(v) FILTER (cell = 'BM') AS bm, max(v) FILTER (cell = 'BH') AS bh FROM r GROUP BY 1)
 SELECT month, round((sl + sm + sh) / 3 - (bl + bm + bh) / 3, 8) AS smb, round((sh + bh) / 2 - (sl + bl) / 2, 8) AS hml FROM w""")
def ap5(spark, sf_dir):
    m = monthly(spark, sf_dir).where("ret is not null and cap_lag > 0").withColumn("formation", F.year("month").cast("long") - (F.month("month") <= 6).cast("int"))
    return _r(st.two_by_three(m.join(_june(spark, sf_dir).select("stock", "formation", "cell"), ["stock", "formation"])), 8, "smb", "hml")


@query("ap8_event_study", f"""{WIDE_SQL}, e0 AS (SELECT s.stock, s.report_month AS event_month, year(s.report_month) AS year, s.assets / p.assets - 1 AS signal FROM snaps s ASOF JOIN snaps p ON s.stock = p.stock AND last_day(s.report_month - INTERVAL 9 MONTH) >= p.report_month),
 e1 AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY signal, stock) AS r, count(*) OVER (PARTITION BY year) AS n FROM e0), e2 AS (SELECT *, CAST(greatest(1, ((r - 1) * 5 + n - 2) // (n - 1)) AS INT) AS grp FROM e1 WHERE n >= 25),
 e3 AS (SELECT e2.*, k, last_day(event_month + to_months(CAST(k AS INT))) AS month FROM e2 CROSS JOIN (SELECT unnest(generate_series(-3, 12)) AS k)), ra AS (SELECT stock, month, ret - avg(ret) OVER (PARTITION BY month) AS ra FROM mon WHERE ret IS NOT NULL),
 g AS (SELECT grp, CAST(k AS INT) AS k, count(*) AS n, avg(ra) AS mean FROM e3 JOIN ra USING (stock, month) GROUP BY 1, 2)
 SELECT grp AS "group", k, n, round(mean, 7) AS mean, round(sum(mean) OVER (PARTITION BY grp ORDER BY k), 7) AS cumulative FROM g""")
def ap8(spark, sf_dir):
    from ledgerline.plans.pit_queries import snapshots

    e = pit.add_previous(snapshots(spark, sf_dir), ["assets"]).where("assets_prev is not null")
    e = e.select("stock", F.col("report_month").alias("event_month"), F.year("report_month").alias("year"), (F.col("assets") / F.col("assets_prev") - 1).alias("signal"))
    return _r(st.event_study(e, monthly(spark, sf_dir), -3, 12, 5), 7, "mean", "cumulative")


@query("adj4_edge_spread", f"""{PANEL_SQL}, n0 AS (SELECT stock, date, row_number() OVER w AS k, CASE WHEN open > 0 THEN ln(open) END AS o, CASE WHEN high > 0 THEN ln(high) END AS h, CASE WHEN low > 0 THEN ln(low) END AS l, CASE WHEN close > 0 THEN ln(close) END AS c FROM panel WINDOW w AS (PARTITION BY stock ORDER BY date)),
 n1 AS (SELECT *, (h + l) / 2 AS m, lag(h) OVER w AS h1, lag(l) OVER w AS l1, lag(c) OVER w AS c1, (lag(h) OVER w + lag(l) OVER w) / 2 AS m1 FROM n0 WINDOW w AS (PARTITION BY stock ORDER BY date)),
 n2 AS (SELECT *, m - o AS r1, o - m1 AS r2, m - c1 AS r3, c1 - m1 AS r4, o - c1 AS r5, CAST(h <> l OR l <> c1 AS DOUBLE) AS t FROM n1),
 n3 AS (SELECT *, t * CAST(o <> h AS DOUBLE) AS p1, t * CAST(o <> l AS DOUBLE) AS p2, t * CAST(c1 <> h1 AS DOUBLE) AS p3, t * CAST(c1 <> l1 AS DOUBLE) AS p4 FROM n2),
 n4 AS (SELECT stock, date, k, sum(t) OVER q AS nt, count(r4) OVER q AS known, avg(p1) OVER q + avg(p2) OVER q AS po, avg(p3) OVER q + avg(p4) OVER q AS pc, avg(r1) OVER q / nullif(avg(t) OVER q, 0) AS g1, avg(r3) OVER q / nullif(avg(t) OVER q, 0) AS g3, avg(r5) OVER q / nullif(avg(t) OVER q, 0) AS g5 FROM n3 WINDOW q AS (PARTITION BY stock ORDER BY date ROWS 19 PRECEDING)),
 n5 AS (SELECT a.stock, a.date, -4 / po * (y.r1 - y.t * g1) * y.r2 - 4 / pc * (y.r3 - y.t * g3) * y.r4 AS x1, -4 / po * (y.r1 - y.t * g1) * y.r5 - 4 / pc * (y.r5 - y.t * g5) * y.r4 AS x2 FROM (SELECT *, unnest(generate_series(0, 19)) AS back FROM n4 WHERE nt >= 2 AND po <> 0 AND pc <> 0 AND known = 20) a JOIN n3 y ON y.stock = a.stock AND y.k = a.k - a.back),
 n6 AS (SELECT stock, date, avg(x1) AS e1, avg(x2) AS e2, avg(x1 * x1) - avg(x1) * avg(x1) AS v1, avg(x2 * x2) - avg(x2) * avg(x2) AS v2 FROM n5 GROUP BY 1, 2),
 n7 AS (SELECT stock, date, CASE WHEN v1 + v2 > 0 THEN (v2 * e1 + v1 * e2) / (v1 + v2) ELSE (e1 + e2) / 2 END AS s FROM n6)
 SELECT n0.stock, n0.date, CASE WHEN s IS NOT NULL THEN round(least(greatest(sign(s) * sqrt(abs(s)), 0), 0.25), 6) END AS spread FROM n0 LEFT JOIN n7 ON n7.stock = n0.stock AND n7.date = n0.date""")
def adj4(spark, sf_dir):
    """The SQL takes each window's rows by a join and the formula as published; a test holds single windows against it too."""
    return st.edge_spread(daily_panel(spark, sf_dir)).select("stock", "date", F.round("spread", 6).alias("spread"))
