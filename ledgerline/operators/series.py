"""Return series: deviations, cumulation, profiles of daily returns, currencies, comparisons with a benchmark, window sums.

A series has a row for each month (or day); `key` names the series where there are several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.frames import by, correlation


def largest_deviations(series: DataFrame, a: str, b: str, n: int = 10) -> DataFrame:
    """PF11: the n rows in which two series differ most."""
    return series.withColumn("deviation", F.col(a) - F.col(b)).where("deviation is not null").orderBy(F.desc(F.abs("deviation")), "month").limit(n)


def cumulative(series: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """PF17: compound return up to each row; logs are summed as decimals, so that the order of partial sums does not matter."""
    s = series if key else series.withColumn("_one", F.lit(1))
    step = F.round(F.log(1 + F.round(value, 8)), 9).cast("decimal(18,9)")
    total = F.sum(step).over(by(key or "_one", order="month").rowsBetween(Window.unboundedPreceding, 0)).cast("double")
    return s.withColumn("cumulative", F.exp(total) - 1).drop("_one")


def daily_profile(panel: DataFrame, large: float) -> DataFrame:
    """PF13: for each year: rows, zero, large and missing returns."""
    r = F.col("ret")
    return panel.groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n"), F.count_if(r == 0).alias("zero"), F.count_if(F.abs(r) > large).alias("large"), F.count_if(r.isNull()).alias("missing"))


def volatility_profile(panel: DataFrame, quantiles: tuple[float, ...] = (0.1, 0.5, 0.9), digits: int = 8) -> DataFrame:
    """PF14: how the standard deviations of the stocks' returns are spread."""
    v = panel.groupBy("stock").agg(F.round(F.stddev_samp("ret"), digits).alias("s"))
    return v.agg(F.count("*").alias("n"), *[F.percentile("s", F.lit(q)).alias(f"p{round(100 * q)}") for q in quantiles], F.max("s").alias("max"))


def members_over_time(uni: DataFrame, group: str) -> DataFrame:
    """EU3: stocks and total cap of each month and group."""
    return uni.groupBy("month", group).agg(F.count_distinct("stock").alias("stocks"), F.sum("market_cap").alias("cap"))


def local_against_euro(monthly: DataFrame, adopted: Column, local: str = "ret", euro: str = "ret_eur", tolerance: float = 1e-6) -> DataFrame:
    """EU4: share of stock-months whose local and euro returns differ: before and after the date of adoption, or without one."""
    m = monthly.where(F.col(local).isNotNull())
    phase = F.when(adopted.isNull(), "no euro").when(F.col("month") < adopted, "before").otherwise("after")
    return m.groupBy(phase.alias("phase")).agg(F.count("*").alias("n"), F.avg((F.abs(F.col(euro) - F.col(local)) > tolerance).cast("int")).alias("share_different"))


def rate_changes(rates: DataFrame) -> DataFrame:
    """EU5: each month's rate over that of the month before (month, change)."""
    r = rates.withColumn("_one", F.lit(1)).withColumn("change", F.col("rate") / F.lag("rate").over(by("_one", order="month")))
    return r.where("change is not null").select("month", "change")


def to_currency(series: DataFrame, changes: DataFrame, value: str, name: str, back: bool = False) -> DataFrame:
    """EU5: a return series in the currency that the rate's change leads to, or back from it."""
    factor = 1 / F.col("change") if back else F.col("change")
    return series.join(changes, "month").withColumn(name, (1 + F.col(value)) * factor - 1).drop("change")


def compare_with(series: DataFrame, bench: DataFrame, key: str, value: str, least: int = 24) -> DataFrame:
    """EU6: each series against one benchmark (month, bench): months in common, correlation, slope, tracking error and mean difference."""
    j = series.join(bench, "month").withColumn("_d", F.col(value) - F.col("bench"))
    out = j.groupBy(key).agg(F.count("*").alias("n"), correlation(value, "bench").alias("corr"), F.regr_slope(value, "bench").alias("beta"), F.stddev_samp("_d").alias("te"), F.avg("_d").alias("mean_diff"))
    return out.where(F.col("n") >= least)


def lead_lag(series: DataFrame, bench: DataFrame, key: str, value: str, shifts: range = range(-2, 3), digits: int = 7) -> DataFrame:
    """EU7: correlation of each series with the benchmark at shifts of some months, and which shift fits best (the largest in size)."""
    g = series.withColumn("shift", F.explode(F.array(*map(F.lit, shifts)))).withColumn("month", F.last_day(F.add_months("month", F.col("shift"))))
    c = g.join(bench, "month").groupBy(key, "shift").agg(F.round(correlation(value, "bench"), digits).alias("corr"))
    return c.withColumn("best", F.col("shift") == F.max_by("shift", F.abs("corr")).over(by(key)))


def window_sums(steps: DataFrame, value: str, windows: dict[str, tuple[int, int]]) -> DataFrame:
    """AP9: sums of a series over windows of its steps k, both ends included."""
    cells = [F.when(F.col("k").between(*ends), F.lit(name)) for name, ends in windows.items()]
    return steps.select(F.explode(F.array_compact(F.array(*cells))).alias("window"), value).groupBy("window").agg(F.sum(value).alias("total"))


def numbered(series: DataFrame, order: str = "month") -> DataFrame:
    """The rows with their number k in order, from 1: for series, of a row for each month."""
    return series.withColumn("_one", F.lit(1)).withColumn("k", F.row_number().over(by("_one", order=order))).drop("_one")
