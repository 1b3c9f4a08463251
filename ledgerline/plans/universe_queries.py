"""Queries of the monthly universe and of portfolios, on the proxy panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators import series as sr
from ledgerline.operators import universe as u
from ledgerline.plans.registry import query
from ledgerline.sources.proxy import PANEL_SQL, daily_panel, statics

VALUES = ["close", "market_cap", "return_index"]


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return u.monthly_universe(daily_panel(spark, sf_dir), VALUES)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return u.consecutive_returns(universe(spark, sf_dir)).withColumn("ret", F.round("ret", 8))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _even(df: DataFrame) -> DataFrame:
    """A mean of few rounded returns can be a tie, which the engines round differently: it is moved off the tie."""
    return df.withColumn("ew", F.col("ew") + 1e-12)


@query("uni1_monthly_universe", f"{PANEL_SQL} SELECT *, min(month) OVER (PARTITION BY stock) AS first_month, max(month) OVER (PARTITION BY stock) AS last_month FROM uni")
def uni1(spark, sf_dir):
    return universe(spark, sf_dir)


_CUTS = ", ".join(f"quantile_cont(market_cap, {k / 5}) AS c{k}" for k in range(1, 5))
_GROUP = "1 + " + " + ".join(f"CAST(market_cap > c{k} AS INT)" for k in range(1, 5))


@query("uni3_size_groups", f"{PANEL_SQL}, c AS (SELECT month, {_CUTS} FROM uni WHERE stock % 2 = 0 GROUP BY 1) SELECT stock, month, market_cap, {_GROUP} AS size_group FROM uni LEFT JOIN c USING (month)")
def uni3(spark, sf_dir):
    return u.size_groups(universe(spark, sf_dir), F.col("stock") % 2 == 0).select("stock", "month", "market_cap", "size_group")


@query("uni4_size_groups_by_country", f"{PANEL_SQL}, x AS (SELECT uni.*, country FROM uni JOIN statics USING (stock)), c AS (SELECT month, country, {_CUTS} FROM x GROUP BY 1, 2) SELECT stock, month, country, {_GROUP} AS size_group FROM x JOIN c USING (month, country)")
def uni4(spark, sf_dir):
    x = universe(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "country"), "stock")
    return u.size_groups(x, F.lit(True), 5, "month", "country").select("stock", "month", "country", "size_group")


_GRID = """, o AS (SELECT o_custkey AS cust, last_day(CAST(o_orderdate AS DATE)) AS month, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price FROM orders GROUP BY 1, 2),
 g AS (SELECT cust, last_day(CAST(unnest(generate_series(date_trunc('month', min(month)), date_trunc('month', max(month)), INTERVAL 1 MONTH)) AS DATE)) AS month FROM o GROUP BY 1),
 f AS (SELECT g.cust, g.month, price FROM g LEFT JOIN o ON o.cust = g.cust AND o.month = g.month)"""


def _orders(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_custkey").alias("cust"), F.last_day("o_orderdate").alias("month"))
    return u.on_month_grid(o.agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("price")), "cust", "month", ["price"])


@query("uni5_month_grid_returns", f"{PANEL_SQL}{_GRID} SELECT cust, month, price, round(price / lag(price) OVER w - 1, 8) AS ret, round(ln(price / lag(price) OVER w), 8) AS log_ret FROM f WINDOW w AS (PARTITION BY cust ORDER BY month)")
def uni5(spark, sf_dir):
    return _orders(spark, sf_dir).withColumns({"ret": F.round(u.step_return("price", "cust", "month"), 8), "log_ret": F.round(u.step_return("price", "cust", "month", True), 8)})


@query("der1_consecutive_returns", f"{PANEL_SQL} SELECT stock, month, ret, cap_lag FROM mon")
def der1(spark, sf_dir):
    return monthly(spark, sf_dir).select("stock", "month", "ret", "cap_lag")


_OK = "FROM mon WHERE ret IS NOT NULL AND cap_lag > 0"


@query("pf2_value_weighted", f"{PANEL_SQL} SELECT month, round(sum(ret * cap_lag) / sum(cap_lag), 8) AS vw {_OK} GROUP BY 1")
def pf2(spark, sf_dir):
    return _rounded(u.portfolios(monthly(spark, sf_dir)), 8, "vw").select("month", "vw")


@query("pf3_equally_weighted", f"{PANEL_SQL} SELECT month, round(avg(ret) + 1e-12, 8) AS ew, count(*) AS n {_OK} GROUP BY 1")
def pf3(spark, sf_dir):
    return _rounded(_even(u.portfolios(monthly(spark, sf_dir))), 8, "ew").select("month", "ew", "n")


_CLEAN = """, pr AS (SELECT *, coalesce((ret > 0.06 AND lead(ret) OVER w < -0.04) OR (ret < -0.04 AND lead(ret) OVER w > 0.06), false) AS pair FROM panel WHERE NOT unadj_close <= 0 WINDOW w AS (PARTITION BY stock ORDER BY date)),
 cl AS (SELECT * FROM (SELECT *, pair OR coalesce(lag(pair) OVER (PARTITION BY stock ORDER BY date), false) AS bad FROM pr) WHERE NOT bad),
 cu AS (SELECT stock, last_day(date) AS month, arg_max(market_cap, date) AS market_cap, arg_max(return_index, date) AS return_index FROM cl GROUP BY 1, 2),
 cm AS (SELECT *, CASE WHEN date_diff('month', lag(month) OVER w, month) = 1 THEN round(return_index / lag(return_index) OVER w - 1, 8) END AS ret,
  CASE WHEN date_diff('month', lag(month) OVER w, month) = 1 THEN lag(market_cap) OVER w END AS cap_lag FROM cu WINDOW w AS (PARTITION BY stock ORDER BY month))"""


@query("pf4_monthly_portfolios", f"{PANEL_SQL}{_CLEAN} SELECT month, round(sum(ret * cap_lag) / sum(cap_lag), 8) AS vw, round(avg(ret) + 1e-12, 8) AS ew, count(*) AS n FROM cm WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1")
def pf4(spark, sf_dir):
    """The flagship: clean the daily panel, condense it to months, weight the returns of consecutive months."""
    from ledgerline.operators import filters as f

    p = f.outlier_pairs(f.nonsense_prices(daily_panel(spark, sf_dir)), 0.06, -0.04)
    m = u.consecutive_returns(u.monthly_universe(p, ["market_cap", "return_index"])).withColumn("ret", F.round("ret", 8))
    return _rounded(_even(u.portfolios(m)), 8, "vw", "ew")


@query("pf5_weights", f"{PANEL_SQL} SELECT stock, month, round(cap_lag / sum(cap_lag) OVER (PARTITION BY month), 9) AS weight {_OK}")
def pf5(spark, sf_dir):
    return _rounded(u.weights(monthly(spark, sf_dir)), 9, "weight").select("stock", "month", "weight")


@query("pf6_daily_portfolios", f"""{PANEL_SQL}, k AS (SELECT date, row_number() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM panel)),
 d AS (SELECT stock, date, ret, CASE WHEN k - lag(k) OVER w = 1 THEN lag(market_cap) OVER w END AS cap_lag FROM panel JOIN k USING (date) WINDOW w AS (PARTITION BY stock ORDER BY date))
 SELECT date, round(sum(ret * cap_lag) / sum(cap_lag), 8) AS vw, round(avg(ret), 8) + 0.0 AS ew, count(*) AS n FROM d WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1""")
def pf6(spark, sf_dir):
    return _rounded(u.daily_portfolios(daily_panel(spark, sf_dir)), 8, "vw", "ew").withColumn("ew", F.col("ew") + 0.0)


_SERIES = ", s AS (SELECT month, avg(ret) AS ew, sum(ret * cap_lag) / sum(cap_lag) AS vw FROM mon WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1)"


@query("pf9_rolling_fit", f"{PANEL_SQL}{_SERIES} SELECT month, CASE WHEN count(*) OVER w = 12 THEN round(corr(vw, ew) OVER w, 6) END AS corr, CASE WHEN count(*) OVER w = 12 THEN round(covar_samp(vw, ew) OVER w / var_samp(ew) OVER w, 6) END AS beta FROM s WINDOW w AS (ORDER BY month ROWS 11 PRECEDING)")
def pf9(spark, sf_dir):
    s = u.portfolios(monthly(spark, sf_dir)).withColumn("series", F.lit("all"))
    return _rounded(u.rolling_fit(s, "vw", "ew", 12), 6, "corr", "beta").select("month", "corr", "beta")


@query("pf11_largest_deviations", f"{PANEL_SQL}{_SERIES} SELECT month, round(vw - ew, 8) AS deviation FROM s ORDER BY abs(vw - ew) DESC LIMIT 10")
def pf11(spark, sf_dir):
    return _rounded(sr.largest_deviations(u.portfolios(monthly(spark, sf_dir)), "vw", "ew"), 8, "deviation").select("month", "deviation")


@query("pf12_universe_over_time", f"""{PANEL_SQL}, w AS (SELECT *, cap_lag / sum(cap_lag) OVER (PARTITION BY month) AS weight {_OK}), r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY weight DESC, stock) AS r FROM w)
 SELECT month, count(*) AS n, round(sum(cap_lag), 2) AS cap, round(max(weight), 9) AS max_weight, max(stock) FILTER (r = 1) AS max_stock, round(sum(weight) FILTER (r <= 10), 9) AS top10 FROM r GROUP BY 1""")
def pf12(spark, sf_dir):
    return _rounded(_rounded(u.universe_over_time(monthly(spark, sf_dir)), 9, "max_weight", "top10"), 2, "cap")


@query("pf13_daily_profile", f"{PANEL_SQL} SELECT year(date) AS year, count(*) AS n, count(*) FILTER (ret = 0) AS zero, count(*) FILTER (abs(ret) > 0.05) AS large, count(*) FILTER (ret IS NULL) AS missing FROM panel GROUP BY 1")
def pf13(spark, sf_dir):
    return sr.daily_profile(daily_panel(spark, sf_dir), 0.05).withColumn("year", F.col("year").cast("long"))


@query("pf14_volatility_profile", f"{PANEL_SQL}, v AS (SELECT stock, round(stddev_samp(ret), 8) AS s FROM panel GROUP BY 1) SELECT count(*) AS n, quantile_cont(s, 0.1) AS p10, quantile_cont(s, 0.5) AS p50, quantile_cont(s, 0.9) AS p90, max(s) AS max FROM v")
def pf14(spark, sf_dir):
    return sr.volatility_profile(daily_panel(spark, sf_dir))


@query("pf15_cap_jumps", f"{PANEL_SQL}, c AS (SELECT stock, month, round(market_cap / close, 6) AS s FROM uni), d AS (SELECT *, s / lag(s) OVER (PARTITION BY stock ORDER BY month) AS change FROM c) SELECT stock, month, round(change, 6) AS change FROM d WHERE change > 3.01 OR change < 1 / 3.01")
def pf15(spark, sf_dir):
    m = universe(spark, sf_dir).withColumns({"market_cap": F.round(F.col("market_cap") / F.col("close"), 6), "close": F.lit(1.0)})
    return _rounded(u.cap_jumps(m, 3.01), 6, "change").select("stock", "month", "change")


@query("pf16_flags", f"{PANEL_SQL}{_SERIES}, v AS (SELECT corr(vw, ew) AS corr, stddev_samp(vw - ew) AS te, CAST(NULL AS DOUBLE) AS alpha FROM s) SELECT CASE WHEN corr IS NULL THEN 'n/a' WHEN corr >= 0.99 THEN 'ok' ELSE 'CHECK' END AS corr_flag, CASE WHEN te IS NULL THEN 'n/a' WHEN te BETWEEN 0 AND 0.02 THEN 'ok' ELSE 'CHECK' END AS te_flag, CASE WHEN alpha IS NULL THEN 'n/a' ELSE 'CHECK' END AS alpha_flag FROM v")
def pf16(spark, sf_dir):
    v = u.portfolios(monthly(spark, sf_dir)).agg(F.corr("vw", "ew").alias("corr"), F.stddev_samp(F.col("vw") - F.col("ew")).alias("te"), F.lit(None).cast("double").alias("alpha"))
    flag = lambda c, ok: F.when(F.col(c).isNull(), "n/a").when(ok, "ok").otherwise("CHECK").alias(f"{c}_flag")
    return v.select(flag("corr", F.col("corr") >= 0.99), flag("te", F.col("te").between(0, 0.02)), flag("alpha", F.lit(False)))


@query("pf17_cumulative", f"{PANEL_SQL}{_SERIES} SELECT month, round(exp(CAST(sum(CAST(round(ln(1 + round(vw, 8)), 9) AS DECIMAL(18,9))) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE)) - 1, 7) AS cumulative FROM s")
def pf17(spark, sf_dir):
    return sr.cumulative(u.portfolios(monthly(spark, sf_dir)), "vw").select("month", F.round("cumulative", 7).alias("cumulative"))


@query("eu2_country_portfolios", f"{PANEL_SQL} SELECT month, country, round(sum(ret * cap_lag) / sum(cap_lag), 8) AS vw, count(*) AS n FROM mon JOIN statics USING (stock) WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2")
def eu2(spark, sf_dir):
    m = monthly(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "country"), "stock")
    return _rounded(u.portfolios(m, "month", "country"), 8, "vw").drop("ew")


@query("eu3_universe_by_country", f"{PANEL_SQL} SELECT month, country, count(DISTINCT stock) AS stocks, round(sum(market_cap), 2) AS cap FROM uni JOIN statics USING (stock) GROUP BY 1, 2")
def eu3(spark, sf_dir):
    m = universe(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "country"), "stock")
    return _rounded(sr.members_over_time(m, "country"), 2, "cap")


@query("eu4_local_vs_euro", f"""{PANEL_SQL}, x AS (SELECT mon.*, region, CASE region WHEN 'EUROPE' THEN DATE '1996-01-31' WHEN 'AMERICA' THEN DATE '1998-01-31' END AS adopted FROM mon JOIN statics USING (stock)),
 y AS (SELECT *, ret + CASE WHEN month(month) % 4 = 0 THEN 0.01 ELSE 0 END AS ret_eur, CASE WHEN adopted IS NULL THEN 'no euro' WHEN month < adopted THEN 'before' ELSE 'after' END AS phase FROM x WHERE ret IS NOT NULL)
 SELECT phase, count(*) AS n, avg(CAST(abs(ret_eur - ret) > 1e-6 AS INT)) AS share_different FROM y GROUP BY 1""")
def eu4(spark, sf_dir):
    """Share of months whose local and euro returns differ, before and after a region's adoption of the euro."""
    adopted = F.when(F.col("region") == "EUROPE", F.lit("1996-01-31").cast("date")).when(F.col("region") == "AMERICA", F.lit("1998-01-31").cast("date"))
    m = monthly(spark, sf_dir).where("ret is not null").join(statics(spark, sf_dir).select("stock", "region"), "stock")
    m = m.withColumn("ret_eur", F.col("ret") + F.when(F.month("month") % 4 == 0, 0.01).otherwise(0.0))
    return sr.local_against_euro(m, adopted)


@query("eu5_currency_conversion", f"""{PANEL_SQL}, o AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS month, round(sum(o_totalprice) / count(*), 2) AS rate FROM orders GROUP BY 1),
 l AS (SELECT month, rate, lag(rate) OVER (ORDER BY month) AS rate0 FROM o){_SERIES}
 SELECT month, round((1 + vw) * rate / rate0 - 1, 7) AS usd, round((1 + ((1 + vw) * rate / rate0 - 1)) / (rate / rate0) - 1, 7) AS eur FROM s JOIN l USING (month) WHERE rate0 IS NOT NULL""")
def eu5(spark, sf_dir):
    """A return series in another currency by month-end rates, and back."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.last_day("o_orderdate").alias("month")).agg(F.round(F.sum("o_totalprice") / F.count("*"), 2).alias("rate"))
    changes = sr.rate_changes(o)
    s = sr.to_currency(u.portfolios(monthly(spark, sf_dir)).select("month", "vw"), changes, "vw", "usd")
    return _rounded(sr.to_currency(s, changes, "usd", "eur", back=True), 7, "usd", "eur").select("month", "usd", "eur")


_BY_REGION = ", g AS (SELECT month, region, sum(ret * cap_lag) / sum(cap_lag) AS vw FROM mon JOIN statics USING (stock) WHERE ret IS NOT NULL AND cap_lag > 0 GROUP BY 1, 2)"


def _regions(spark, sf_dir):
    m = monthly(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "region"), "stock")
    return u.portfolios(m, "month", "region").select("month", "region", "vw")


@query("eu6_compare_series", f"{PANEL_SQL}{_SERIES}{_BY_REGION} SELECT region, count(*) AS n, round(corr(g.vw, s.vw), 6) AS corr, round(regr_slope(g.vw, s.vw), 6) AS beta, round(stddev_samp(g.vw - s.vw), 8) AS te, round(avg(g.vw - s.vw), 8) AS mean_diff FROM g JOIN s USING (month) GROUP BY 1 HAVING count(*) >= 24")
def eu6(spark, sf_dir):
    s = u.portfolios(monthly(spark, sf_dir)).select("month", F.col("vw").alias("bench"))
    return _rounded(_rounded(sr.compare_with(_regions(spark, sf_dir), s, "region", "vw"), 6, "corr", "beta"), 8, "te", "mean_diff")


@query("eu7_lead_lag", f"""{PANEL_SQL}{_SERIES}{_BY_REGION}, k AS (SELECT unnest([-2, -1, 0, 1, 2]) AS shift), c AS (SELECT region, shift, round(corr(g.vw, s.vw), 7) AS corr FROM g JOIN k ON true JOIN s ON s.month = last_day(g.month + to_months(CAST(shift AS INT))) GROUP BY 1, 2)
 SELECT region, shift, corr, shift = arg_max(shift, abs(corr)) OVER (PARTITION BY region) AS best FROM c""")
def eu7(spark, sf_dir):
    s = u.portfolios(monthly(spark, sf_dir)).select("month", F.col("vw").alias("bench"))
    return sr.lead_lag(_regions(spark, sf_dir), s, "region", "vw")


@query("eu8_top_n", f"{PANEL_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY cap_lag DESC, stock) AS r {_OK}) SELECT month, round(sum(ret * cap_lag) / sum(cap_lag), 8) AS vw, count(*) AS n FROM r WHERE r <= 20 GROUP BY 1")
def eu8(spark, sf_dir):
    return _rounded(u.top_n(monthly(spark, sf_dir), 20), 8, "vw").select("month", "vw", "n")


@query("eu9_contributions", f"{PANEL_SQL}, w AS (SELECT *, cap_lag / sum(cap_lag) OVER (PARTITION BY month) AS weight {_OK}) SELECT stock, round(weight * ret, 9) AS contribution FROM w WHERE month = DATE '1997-06-30' ORDER BY abs(weight * ret) DESC, stock LIMIT 15")
def eu9(spark, sf_dir):
    return _rounded(u.contributions(monthly(spark, sf_dir), "1997-06-30", 15), 9, "contribution").select("stock", "contribution")


@query("der2_company_value", f"""{PANEL_SQL}, x AS (SELECT uni.stock, month, market_cap, company, CASE WHEN stock % 3 = 0 THEN 'ISIN00' || (stock // 6) ELSE 'S' END AS isin FROM uni JOIN statics USING (stock)),
 l AS (SELECT *, row_number() OVER (PARTITION BY company, month, CASE WHEN length(isin) > 5 THEN isin ELSE CAST(stock AS VARCHAR) END ORDER BY market_cap DESC, stock) AS r FROM x WHERE market_cap > 0),
 f AS (SELECT company, month, sum(market_cap) AS firm_cap, CAST(count(*) AS INT) AS n_lines FROM l WHERE r = 1 GROUP BY 1, 2)
 SELECT stock, month, n_lines, round(firm_cap, 2) AS firm_cap, round(coalesce(greatest(firm_cap / market_cap, 1), 1), 7) AS firm_factor FROM x LEFT JOIN f USING (company, month)""")
def der2(spark, sf_dir):
    x = universe(spark, sf_dir).join(statics(spark, sf_dir).select("stock", "company"), "stock")
    x = x.withColumn("isin", F.when(F.col("stock") % 3 == 0, F.concat(F.lit("ISIN00"), F.floor(F.col("stock") / 6).cast("string"))).otherwise("S"))
    return _rounded(_rounded(u.company_value(x), 2, "firm_cap"), 7, "firm_factor").select("stock", "month", "n_lines", "firm_cap", "firm_factor")


@query("der3_dividend_yield", f"""{PANEL_SQL}, x AS (SELECT stock, month, ret, ret - CASE WHEN month(month) % 3 = 0 THEN 0.004 ELSE 0.0 END AS retx FROM mon),
 d AS (SELECT *, CASE WHEN ret IS NOT NULL THEN CASE WHEN greatest(ret - retx, 0) <= 1e-10 THEN 0 ELSE greatest(ret - retx, 0) END END AS d FROM x)
 SELECT stock, month, CASE WHEN count(d) OVER w = 12 THEN round(sum(d) OVER w, 7) END AS dy_12m FROM d WINDOW w AS (PARTITION BY stock ORDER BY month ROWS 11 PRECEDING)""")
def der3(spark, sf_dir):
    m = monthly(spark, sf_dir).withColumn("retx", F.col("ret") - F.when(F.month("month") % 3 == 0, 0.004).otherwise(0.0))
    return _rounded(u.dividend_yield(m), 7, "dy_12m").select("stock", "month", "dy_12m")
