"""Queries of the point-in-time layer, emissions and the sustainability dataset, on annual variables of the proxy panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import emissions as em
from ledgerline.operators.listings import first_known, known
from ledgerline.operators import pit
from ledgerline.plans.registry import query
from ledgerline.plans.universe_queries import monthly, universe
from ledgerline.sources.proxy import PANEL_SQL, read, statics

ITEMS = ["sales", "assets", "equity"]


def annual_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual items repeated over the twelve months of their year; some years of sales are a thousand times too large."""
    line = read(spark, sf_dir, "lineitem")
    y = line.groupBy(F.col("l_suppkey").alias("stock"), F.year("l_shipdate").alias("y")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sales"), F.round(F.sum("l_extendedprice"), 2).alias("assets"))
    y = y.withColumn("sales", F.when((F.col("stock") + F.col("y")) % 17 == 0, F.round(F.col("sales") * 1000, 2)).when((F.col("stock") + F.col("y")) % 23 == 0, -F.col("sales")).otherwise(F.col("sales")))
    y = y.withColumn("equity", F.when((F.col("stock") + F.col("y")) % 5 != 0, F.round(F.col("assets") * 0.4, 4)))
    return y.select("stock", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"), "y", *ITEMS).select("stock", F.last_day(F.make_date("y", "m", F.lit(1))).alias("month"), *ITEMS)


WIDE_SQL = PANEL_SQL + """, yr0 AS (SELECT l_suppkey AS stock, year(l_shipdate) AS y, round(sum(l_extendedprice * (1 - l_discount)), 4) AS s, round(sum(l_extendedprice), 2) AS assets FROM lineitem GROUP BY 1, 2),
yr AS (SELECT stock, y, CASE WHEN (stock + y) % 17 = 0 THEN round(s * 1000, 2) WHEN (stock + y) % 23 = 0 THEN -s ELSE s END AS sales, assets, CASE WHEN (stock + y) % 5 <> 0 THEN round(assets * 0.4, 4) END AS equity FROM yr0),
wide AS (SELECT stock, last_day(make_date(CAST(y AS INT), CAST(m AS INT), 1)) AS month, sales, assets, equity FROM yr, generate_series(1, 12) t(m)),
pos AS (SELECT stock, month, CASE WHEN sales >= 0 THEN sales END AS sales, assets, equity FROM wide),
snaps AS (SELECT stock, month AS report_month, sales, assets, equity FROM (SELECT *, lag(month) OVER w IS NULL OR sales IS DISTINCT FROM lag(sales) OVER w OR assets IS DISTINCT FROM lag(assets) OVER w OR equity IS DISTINCT FROM lag(equity) OVER w OR date_diff('month', lag(month) OVER w, month) > 1 AS fresh FROM pos WINDOW w AS (PARTITION BY stock ORDER BY month)) WHERE fresh),
stated AS (SELECT stock, month, last_day(month + to_months(CAST(CASE stock % 3 WHEN 0 THEN 5 WHEN 1 THEN 11 ELSE 30 END AS INT))) AS fye FROM wide),
fy AS (SELECT s.*, CASE WHEN date_diff('month', s.report_month, t.fye) BETWEEN 0 AND 23 THEN t.fye ELSE last_day(s.report_month + INTERVAL 11 MONTH) END AS fye FROM snaps s LEFT JOIN stated t ON t.stock = s.stock AND t.month = s.report_month),
av AS (SELECT * FROM (SELECT *, last_day(fye + INTERVAL 4 MONTH) AS available FROM fy) QUALIFY row_number() OVER (PARTITION BY stock, available ORDER BY report_month DESC) = 1),
att0 AS (SELECT m.stock, m.month, m.market_cap, m.ret, a.sales, a.assets, a.equity, a.fye, a.report_month, date_diff('month', a.fye, m.month) AS age FROM mon m ASOF LEFT JOIN av a ON m.stock = a.stock AND m.month >= a.available),
att AS (SELECT stock, month, market_cap, ret, CASE WHEN age <= 18 THEN sales END AS sales, CASE WHEN age <= 18 THEN assets END AS assets, CASE WHEN age <= 18 THEN equity END AS equity, CASE WHEN age <= 18 THEN fye END AS fye, CASE WHEN age <= 18 THEN report_month END AS report_month, CAST(CASE WHEN age <= 18 THEN age END AS DOUBLE) AS fund_age FROM att0)
"""


def clean(spark, sf_dir):
    return pit.drop_negatives(annual_wide(spark, sf_dir), ["sales"])


def snapshots(spark, sf_dir):
    return pit.report_snapshots(clean(spark, sf_dir), ITEMS)


def dated(spark, sf_dir):
    stated = annual_wide(spark, sf_dir).select("stock", "month", F.last_day(F.add_months("month", F.when(F.col("stock") % 3 == 0, 5).when(F.col("stock") % 3 == 1, 11).otherwise(30))).alias("fye"))
    return pit.fiscal_year_end(snapshots(spark, sf_dir), stated)


def attached(spark, sf_dir):
    return pit.attach(monthly(spark, sf_dir).select("stock", "month", "market_cap", "ret"), pit.availability(dated(spark, sf_dir)), ITEMS)


@query("src13_merge_variables", f"{WIDE_SQL} SELECT stock, month, sales, assets, equity FROM wide")
def src13(spark, sf_dir):
    return pit.wide_form(pit.long_form(annual_wide(spark, sf_dir), ITEMS), ITEMS)


@query("pit2_load_wide", f"{WIDE_SQL} SELECT stock, month, sales, assets FROM wide WHERE stock IN (SELECT stock FROM uni WHERE n_days >= 12)")
def pit2(spark, sf_dir):
    firms = universe(spark, sf_dir).where("n_days >= 12").select("stock").distinct()
    return pit.wide_form(pit.long_form(annual_wide(spark, sf_dir), ITEMS).join(firms, "stock", "left_semi"), ["sales", "assets"])


@query("pit3_clean_raw", f"""{WIDE_SQL}, e AS (SELECT *, CASE WHEN (stock + year(month)) % 17 = 0 THEN NULL ELSE sales END AS c FROM pos) SELECT stock, month, c AS sales FROM e""")
def pit3(spark, sf_dir):
    """Negatives and whole episodes of a flagged unit error become null; flags stand at the first month of an episode."""
    long = clean(spark, sf_dir).select("stock", "month", F.lit("sales").alias("variable"), F.col("sales").alias("value"))
    errors = long.where((F.month("month") == 1) & ((F.col("stock") + F.year("month")) % 17 == 0)).select("stock", "variable", "month")
    return pit.clear_episodes(long, errors).select("stock", "month", F.col("value").alias("sales"))


@query("pit4_report_snapshots", f"{WIDE_SQL} SELECT * FROM snaps")
def pit4(spark, sf_dir):
    return snapshots(spark, sf_dir)


@query("pit5_previous_reports", f"{WIDE_SQL} SELECT s.stock, s.report_month, s.sales, p.sales AS sales_prev, p.assets AS assets_prev, p.report_month AS prev_report_month FROM snaps s ASOF LEFT JOIN snaps p ON s.stock = p.stock AND last_day(s.report_month - INTERVAL 9 MONTH) >= p.report_month")
def pit5(spark, sf_dir):
    return pit.add_previous(snapshots(spark, sf_dir), ["sales", "assets"]).select("stock", "report_month", "sales", "sales_prev", "assets_prev", "prev_report_month")


@query("pit6_fiscal_year_end", f"{WIDE_SQL} SELECT stock, report_month, fye FROM fy")
def pit6(spark, sf_dir):
    return dated(spark, sf_dir).select("stock", "report_month", "fye")


@query("pit7_availability", f"{WIDE_SQL} SELECT stock, report_month, fye, available FROM av")
def pit7(spark, sf_dir):
    return pit.availability(dated(spark, sf_dir)).select("stock", "report_month", "fye", "available")


@query("pit7_availability_june", f"{WIDE_SQL} SELECT stock, report_month, available FROM (SELECT *, last_day(make_date(CAST(year(fye) + 1 AS INT), 6, 1)) AS available FROM fy) QUALIFY row_number() OVER (PARTITION BY stock, available ORDER BY report_month DESC) = 1")
def pit7j(spark, sf_dir):
    return pit.availability(dated(spark, sf_dir), june=True).select("stock", "report_month", "available")


@query("pit8_attach", f"{WIDE_SQL} SELECT stock, month, sales, assets, equity, fye, report_month, fund_age FROM att")
def pit8(spark, sf_dir):
    return attached(spark, sf_dir).select("stock", "month", *ITEMS, "fye", "report_month", F.col("fund_age").cast("double").alias("fund_age"))


@query("pit9_configured", f"""{WIDE_SQL}, j AS (SELECT * FROM (SELECT *, last_day(make_date(CAST(year(fye) + 1 AS INT), 6, 1)) AS available FROM fy) QUALIFY row_number() OVER (PARTITION BY stock, available ORDER BY report_month DESC) = 1),
 x AS (SELECT m.stock, m.month, j.sales, j.fye, date_diff('month', j.fye, m.month) AS age FROM mon m ASOF LEFT JOIN j ON m.stock = j.stock AND m.month >= j.available)
 SELECT stock, month, CASE WHEN age <= 24 THEN sales END AS sales, CASE WHEN age <= 24 THEN fye END AS fye FROM x""")
def pit9(spark, sf_dir):
    """The baseline in another configuration: first use in June, for 24 months."""
    config = pit.BaselineConfig(june=True, max_age=24)
    return pit.baseline(monthly(spark, sf_dir).select("stock", "month"), dated(spark, sf_dir), ITEMS, config).select("stock", "month", "sales", "fye")


@query("pit10_baseline", f"{WIDE_SQL} SELECT a.stock, month, country, market_cap, sales, assets, equity, fund_age, round(CASE WHEN market_cap <> 0 THEN equity / market_cap END, 6) AS bm FROM att a LEFT JOIN statics USING (stock)")
def pit10(spark, sf_dir):
    b = attached(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "country"), "stock", "left")
    return b.select("stock", "month", "country", "market_cap", *ITEMS, F.col("fund_age").cast("double").alias("fund_age"), F.round(F.try_divide("equity", "market_cap"), 6).alias("bm"))


@query("pit10_coverage_by_year", f"{WIDE_SQL} SELECT year(month) AS year, count(*) AS n, avg(CAST(sales IS NOT NULL AS INT)) AS sales, avg(CAST(equity IS NOT NULL AS INT)) AS equity FROM att GROUP BY 1")
def pit10c(spark, sf_dir):
    return pit.coverage_by_year(attached(spark, sf_dir), ["sales", "equity"]).withColumn("year", F.col("year").cast("long"))


@query("der4_company_id", f"{PANEL_SQL} SELECT stock, coalesce(CASE WHEN company % 3 <> 0 THEN 'A' || company END, nullif(trim(CASE WHEN company % 2 = 0 THEN ' ' ELSE 'B' || company END), '')) AS firm_id FROM statics")
def der4(spark, sf_dir):
    s = statics(spark, sf_dir)
    a, b = F.when(F.col("company") % 3 != 0, F.concat(F.lit("A"), "company")), F.when(F.col("company") % 2 == 0, " ").otherwise(F.concat(F.lit("B"), "company"))
    return s.withColumns({"_a": a, "_b": b}).select("stock", first_known("_a", "_b").alias("firm_id"))


@query("der6_controls", f"""{WIDE_SQL}, p AS (SELECT a.*, lag(sales, 12) OVER (PARTITION BY stock ORDER BY month) AS sales_prev FROM att a)
 SELECT stock, month, round(sales / nullif(assets, 0), 7) AS leverage, round(CASE WHEN equity > 0 THEN sales / equity END, 7) AS roe, round(CASE WHEN sales / nullif(sales_prev, 0) > 0 THEN ln(sales / sales_prev) END, 7) AS sales_growth, CASE WHEN count(ret) OVER w = 12 THEN round(stddev_samp(ret) OVER w, 7) END AS vol_12m FROM p WINDOW w AS (PARTITION BY stock ORDER BY month ROWS 11 PRECEDING)""")
def der6(spark, sf_dir):
    d = attached(spark, sf_dir).withColumn("sales_prev", F.lag("sales", 12).over(pit.by_month())).withColumns({"debt": F.col("sales"), "income": F.col("sales")})
    return pit.controls(d).select("stock", "month", *[F.round(c, 7).alias(c) for c in ("leverage", "roe", "sales_growth", "vol_12m")])


EM_SQL = WIDE_SQL + """, em0 AS (SELECT stock, report_month, fye, CASE WHEN stock % 4 = 0 THEN sales END AS total, CASE WHEN stock % 4 = 1 THEN assets * 0.25 END AS scope1, CASE WHEN stock % 4 = 1 THEN assets * 0.5 END AS scope2, CASE WHEN stock % 4 <> 3 THEN assets END AS estimate FROM fy),
emx AS (SELECT *, CASE WHEN total > 0 THEN total END AS x FROM em0),
emn AS (SELECT *, lag(x) OVER w AS b, lead(x) OVER w AS a FROM emx WINDOW w AS (PARTITION BY stock ORDER BY report_month)),
em1 AS (SELECT stock, report_month, fye, scope1, scope2, estimate, CASE WHEN NOT coalesce(CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN (x / b > 500 OR b / x > 500) AND (x / a > 500 OR a / x > 500) ELSE coalesce(x / b > 500 OR b / x > 500, x / a > 500 OR a / x > 500, false) END, false) THEN total END AS total FROM emn),
em2 AS (SELECT *, coalesce(total, scope1 + scope2, estimate) AS emission, CASE WHEN coalesce(total, scope1 + scope2, estimate) IS NOT NULL THEN coalesce(total, scope1 + scope2) IS NULL END AS estimated FROM em1),
sfy AS (SELECT stock, fye, arg_max(sales, report_month) AS fsales FROM (SELECT * FROM fy QUALIFY row_number() OVER (PARTITION BY stock, fye ORDER BY report_month DESC) = 1) GROUP BY 1, 2),
em3 AS (SELECT em2.*, CASE WHEN fsales > 0 THEN emission / fsales END AS intensity FROM em2 LEFT JOIN sfy USING (stock, fye)),
emr AS (SELECT stock, fye, emission, estimated FROM em3 QUALIFY row_number() OVER (PARTITION BY stock, fye ORDER BY report_month DESC) = 1),
em4 AS (SELECT e.*, CASE WHEN date_diff('month', r.fye, e.fye) <= 15 AND r.estimated = e.estimated AND r.emission > 0 AND e.emission > 0 THEN ln(e.emission) - ln(r.emission) END AS growth FROM em3 e ASOF LEFT JOIN emr r ON e.stock = r.stock AND last_day(e.fye - INTERVAL 9 MONTH) >= r.fye),
em5 AS (SELECT *, last_day(fye + INTERVAL 12 MONTH) AS available FROM em4 QUALIFY row_number() OVER (PARTITION BY stock, last_day(fye + INTERVAL 12 MONTH) ORDER BY report_month DESC) = 1),
em6 AS (SELECT m.stock, m.month, m.market_cap, m.ret, CASE WHEN date_diff('month', e.fye, m.month) <= 24 THEN e.emission END AS emission, CASE WHEN date_diff('month', e.fye, m.month) <= 24 THEN e.estimated END AS estimated, CASE WHEN date_diff('month', e.fye, m.month) <= 24 THEN e.intensity END AS intensity FROM mon m ASOF LEFT JOIN em5 e ON m.stock = e.stock AND m.month >= e.available)
"""


def emission_snapshots(spark, sf_dir):
    k = F.col("stock") % 4
    s = dated(spark, sf_dir).withColumns({"total": F.when(k == 0, F.col("sales")), "scope1": F.when(k == 1, F.col("assets") * 0.25), "scope2": F.when(k == 1, F.col("assets") * 0.5), "estimate": F.when(k != 3, F.col("assets"))})
    return s.select("stock", "report_month", "fye", "total", "scope1", "scope2", "estimate")


def emission_panel(spark, sf_dir):
    e = pit.emission_values(pit.lone_unit_errors(emission_snapshots(spark, sf_dir), "total"), dated(spark, sf_dir))
    return pit.attach(monthly(spark, sf_dir).select("stock", "month", "market_cap", "ret"), pit.availability(e, 12), ["emission", "estimated", "intensity"], 24)


@query("em1_unit_errors", f"{EM_SQL} SELECT stock, report_month, total FROM em1")
def em1(spark, sf_dir):
    return pit.lone_unit_errors(emission_snapshots(spark, sf_dir), "total").select("stock", "report_month", "total")


@query("em3_sales_by_fiscal_year", f"{EM_SQL} SELECT stock, fye, fsales AS sales FROM sfy")
def em3(spark, sf_dir):
    return pit.sales_by_fiscal_year(dated(spark, sf_dir))


@query("em4_emission_values", f"{EM_SQL} SELECT stock, report_month, emission, CAST(estimated AS DOUBLE) AS estimated, round(intensity, 7) AS intensity, round(growth, 7) AS growth FROM em4")
def em4(spark, sf_dir):
    e = pit.emission_values(pit.lone_unit_errors(emission_snapshots(spark, sf_dir), "total"), dated(spark, sf_dir))
    return e.select("stock", "report_month", "emission", F.col("estimated").cast("double").alias("estimated"), F.round("intensity", 7).alias("intensity"), F.round("growth", 7).alias("growth"))


@query("em6_emissions_panel", f"{EM_SQL} SELECT stock, month, emission, CAST(estimated AS DOUBLE) AS estimated, round(intensity, 7) AS intensity FROM em6")
def em6(spark, sf_dir):
    return emission_panel(spark, sf_dir).select("stock", "month", "emission", F.col("estimated").cast("double").alias("estimated"), F.round("intensity", 7).alias("intensity"))


@query("em7_emission_coverage", f"""{EM_SQL} SELECT year(month) AS year, count(*) AS n, count(*) FILTER (NOT estimated) AS n_reported, count(emission) AS n_any, avg(CAST(coalesce(NOT estimated, false) AS INT)) AS ew_reported,
 round(coalesce(sum(market_cap) FILTER (NOT estimated), 0) / sum(market_cap), 9) AS vw_reported, round(coalesce(sum(market_cap) FILTER (emission IS NOT NULL), 0) / sum(market_cap), 9) AS vw_any FROM em6 WHERE month(month) = 12 GROUP BY 1""")
def em7(spark, sf_dir):
    return pit.emission_coverage(emission_panel(spark, sf_dir)).withColumns({"year": F.col("year").cast("long"), "vw_reported": F.round("vw_reported", 9), "vw_any": F.round("vw_any", 9)})


@query("em8_stock_counts", f"{EM_SQL}, s AS (SELECT stock, count(*) AS n, count(*) FILTER (NOT estimated) AS r FROM em6 WHERE emission IS NOT NULL GROUP BY 1) SELECT count(*) AS stocks, CAST(sum(n) AS BIGINT) AS months, count(*) FILTER (r > 0) AS stocks_reported, CAST(sum(r) AS BIGINT) AS months_reported, count(*) FILTER (r = 0) AS stocks_only_estimated FROM s")
def em8(spark, sf_dir):
    return pit.stock_counts(emission_panel(spark, sf_dir))


@query("sd1_static_tokens", f"{PANEL_SQL}, t AS (SELECT stock, CASE stock % 5 WHEN 0 THEN ' na ' WHEN 1 THEN '#N/A' WHEN 2 THEN '' ELSE ename END AS v FROM statics) SELECT stock, CASE WHEN upper(trim(v)) NOT IN ('', 'NA', '#NA', '#N/A', 'N/A', 'NONE', 'NAN') THEN v END AS value FROM t")
def sd1(spark, sf_dir):
    k = F.col("stock") % 5
    v = F.when(k == 0, " na ").when(k == 1, "#N/A").when(k == 2, "").otherwise(F.col("ename"))
    return statics(spark, sf_dir).withColumn("v", v).select("stock", known(F.col("v")).alias("value"))


@query("sd2_industry_adjusted", f"""{WIDE_SQL}, x AS (SELECT a.stock, month, region, CASE WHEN sales > 0 THEN ln(sales) END AS x FROM att a JOIN statics USING (stock)), m AS (SELECT month, region, median(x) AS m, count(x) AS n FROM x WHERE x IS NOT NULL GROUP BY 1, 2)
 SELECT stock, month, CASE WHEN n >= 5 THEN round(x - m, 7) END AS adjusted FROM x LEFT JOIN m USING (month, region)""")
def sd2(spark, sf_dir):
    d = attached(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "region"), "stock")
    return pit.industry_adjusted(d, "sales", "region", "adjusted").select("stock", "month", F.round("adjusted", 7).alias("adjusted"))


@query("sd3_sustainability_dataset", f"""{EM_SQL} SELECT e.stock, e.month, country, region = 'ASIA' AS is_financial, emission, estimated, round(CASE WHEN e.emission > 0 THEN ln(e.emission) END, 7) AS log_emission, assets, sales FROM em6 e LEFT JOIN att a ON a.stock = e.stock AND a.month = e.month LEFT JOIN statics s ON s.stock = e.stock WHERE emission IS NOT NULL""")
def sd3(spark, sf_dir):
    a = attached(spark, sf_dir).select("stock", "month", "assets", "sales")
    d = em.sustainability_dataset(emission_panel(spark, sf_dir), a, statics(spark, sf_dir), F.col("region") == "ASIA")
    return d.select("stock", "month", "country", "is_financial", "emission", "estimated", F.round("log_emission", 7).alias("log_emission"), "assets", "sales")


@query("sd4_summary_by_year", f"""{EM_SQL} SELECT year(month) AS year, count(*) AS n, count(*) FILTER (NOT estimated) AS reported, count(*) FILTER (region = 'ASIA') AS financial, round(median(intensity) FILTER (region <> 'ASIA'), 7) AS median_intensity FROM em6 JOIN statics USING (stock) WHERE emission IS NOT NULL AND month(month) = 12 GROUP BY 1""")
def sd4(spark, sf_dir):
    d = em.summary_by_year(emission_panel(spark, sf_dir), statics(spark, sf_dir), F.col("region") == "ASIA")
    return d.withColumns({"year": F.col("year").cast("long"), "median_intensity": F.round("median_intensity", 7)})
