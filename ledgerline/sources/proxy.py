"""The proxy research panel on the driver's tables, once as DataFrames and once as SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sums() -> dict[str, Column]:
    """What a stock's day keeps of its lines."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    sums = {"_high": F.max(price), "_low": F.min(price), "_open": F.avg(price), "_value": F.sum("l_extendedprice"), "volume": F.sum("l_quantity")}
    return sums | {"_tax": F.avg("l_tax"), "_discount": F.avg("l_discount")}


def _prices(day: dict[str, Column]) -> dict[str, Column]:
    close = F.round(day["_value"] / day["volume"], 8)
    prices = {"high": F.round(day["_high"], 8), "low": F.round(day["_low"], 8), "open": F.round(day["_open"], 8), "close": close, "volume": day["volume"]}
    return prices | {"market_cap": F.round(day["_value"], 2), "adj_factor": F.round(1 + day["_discount"], 6), "unadj_close": close / F.round(1 + day["_tax"], 6)}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").withColumns({"stock": F.col("l_suppkey"), "date": F.col("l_shipdate").cast("date")})


def _days(lines: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row for each stock and day: return, return index and other aggregates."""
    ret = F.round(F.avg("l_discount") - F.avg("l_tax"), 4) + F.lit(0.0)
    p = lines.groupBy("stock", "date").agg(ret.alias("ret"), *[c.alias(n) for n, c in columns.items()])
    # The cast rounds half up, as the SQL's round does.
    steps = F.sum(F.log(1 + F.col("ret")).cast("decimal(18,8)")).over(Window.partitionBy("stock").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return p.withColumn("return_index", F.round(100 * F.exp(steps.cast("double")), 4))


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each stock (supplier) and day: prices, volume, cap, return and return index."""
    return _days(_lines(spark, sf_dir), _prices(_sums()))


def daily_sums(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    """The daily panel before its prices are worked out, and these, for screens that need them on few rows only.

    The lines of a stock meet before they are added up, in the one exchange that this and later windows by stock need: few lines
    share a day, so sums made before an exchange would be wider than the lines and hardly fewer."""
    sums = _sums()
    return _days(_lines(spark, sf_dir).repartition("stock"), sums), _prices({n: F.col(n) for n in sums})


def last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stock, date) with the last date of each stock of the daily panel, without making the panel."""
    days = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("stock"))
    return days.agg(F.max(F.col("l_shipdate").cast("date")).alias("date"))


def statics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    s = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return s.select(F.col("s_suppkey").alias("stock"), F.col("s_name").alias("ename"), F.col("n_name").alias("country"), F.col("r_name").alias("region"), F.col("s_nationkey").alias("company"), F.col("s_acctbal").alias("acctbal"))


def delistings(panel: DataFrame) -> DataFrame:
    """A made-up delisting date of every third stock: some days before its last row."""
    return panel.groupBy("stock").agg(F.max("date").alias("_last")).select("stock", F.when(F.col("stock") % 3 == 0, F.date_sub("_last", (F.col("stock") % 60).cast("int"))).alias("delisting_date"))


PANEL_SQL = """WITH panel0 AS (
 SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, round(avg(l_discount) - avg(l_tax), 4) + 0.0 AS ret,
  round(max(l_extendedprice / l_quantity), 8) AS high, round(min(l_extendedprice / l_quantity), 8) AS low, round(avg(l_extendedprice / l_quantity), 8) AS open,
  round(sum(l_extendedprice) / sum(l_quantity), 8) AS close, sum(l_quantity) AS volume, round(sum(l_extendedprice), 2) AS market_cap,
  round(1 + avg(l_tax), 6) AS tax_factor, round(1 + avg(l_discount), 6) AS adj_factor
 FROM lineitem GROUP BY 1, 2),
panel AS (
 SELECT * EXCLUDE (tax_factor), close / tax_factor AS unadj_close,
  round(100 * exp(CAST(sum(CAST(round(ln(1 + ret), 8) AS DECIMAL(18,8))) OVER (PARTITION BY stock ORDER BY date ROWS UNBOUNDED PRECEDING) AS DOUBLE)), 4) AS return_index
 FROM panel0),
statics AS (
 SELECT s_suppkey AS stock, s_name AS ename, n_name AS country, r_name AS region, s_nationkey AS company, s_acctbal AS acctbal
 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
delistings AS (
 SELECT stock, CASE WHEN stock % 3 = 0 THEN CAST(max(date) - to_days(CAST(stock % 60 AS INT)) AS DATE) END AS delisting_date FROM panel GROUP BY stock),
uni AS (
 SELECT stock, last_day(date) AS month, count(*) AS n_days, max(date) AS last_date, arg_max(close, date) AS close, arg_max(market_cap, date) AS market_cap, arg_max(return_index, date) AS return_index
 FROM panel GROUP BY 1, 2),
mon AS (
 SELECT *, CASE WHEN date_diff('month', lag(month) OVER w, month) = 1 THEN round(return_index / lag(return_index) OVER w - 1, 8) END AS ret,
  CASE WHEN date_diff('month', lag(month) OVER w, month) = 1 THEN lag(market_cap) OVER w END AS cap_lag
 FROM uni WINDOW w AS (PARTITION BY stock ORDER BY month))
"""
