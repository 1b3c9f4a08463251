"""Monthly universe, size groups, returns over consecutive months, and portfolios of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import months_between
from ledgerline.functions.frames import by, first_rows, full_frame


def monthly_universe(panel: DataFrame, values: list[str]) -> DataFrame:
    """UNI1, UNI2: month-end row of each stock: days, last day, last known value of each column, first and last month."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in values]
    u = panel.groupBy("stock", F.last_day("date").alias("month")).agg(F.count("*").alias("n_days"), F.max("date").alias("last_date"), *last)
    return u.withColumns({"first_month": F.min("month").over(by("stock")), "last_month": F.max("month").over(by("stock"))})


def size_groups(uni: DataFrame, reference: Column, groups: int = 5, *keys: str, name: str = "size_group") -> DataFrame:
    """UNI3, UNI4: 1 + the number of breakpoints below the cap; breakpoints are even quantiles of the reference rows."""
    keys = keys or ("month",)
    cuts = uni.where(reference).groupBy(*keys).agg(F.percentile("market_cap", F.array(*[F.lit(k / groups) for k in range(1, groups)])).alias("_cuts"))
    group = F.when(F.col("market_cap").isNotNull(), F.size(F.filter("_cuts", lambda c: F.col("market_cap") > c)) + 1)
    return uni.join(cuts, list(keys), "left").withColumn(name, F.when(F.col("_cuts").isNotNull(), group)).drop("_cuts")


def on_month_grid(df: DataFrame, key: str, month: str, values: list[str]) -> DataFrame:
    """UNI5, PF1: one row for each month between a key's first and last, with the values where they are known."""
    grid = df.groupBy(key).agg(F.explode(F.sequence(F.trunc(F.min(month), "month"), F.trunc(F.max(month), "month"), F.expr("interval 1 month"))).alias("_m"))
    return grid.select(key, F.last_day("_m").alias(month)).join(df.select(key, month, *values), [key, month], "left")


def step_return(price: str, key: str, month: str, log: bool = False) -> Column:
    """Return to the row before on a grid without gaps."""
    r = F.try_divide(F.col(price), F.lag(price).over(by(key, order=month)))
    return F.log(r) if log else r - 1


def consecutive_returns(uni: DataFrame, index: str = "return_index", name: str = "ret") -> DataFrame:
    """DER1, EU1: return and cap of the month before, only where that month has a row."""
    w = by("stock", order="month")
    next_to = months_between(F.col("month"), F.lag("month").over(w)) == 1
    return uni.withColumns({name: F.when(next_to, F.try_divide(index, F.lag(index).over(w)) - 1), "cap_lag": F.when(next_to, F.lag("market_cap").over(w))})


def portfolios(monthly: DataFrame, *keys: str, value: str = "ret", weight: str = "cap_lag") -> DataFrame:
    """PF2 to PF4, EU2: value- and equally-weighted means over stocks that have a return and a positive weight."""
    ok = monthly.where(f"{value} is not null and {weight} > 0")
    return ok.groupBy(*(keys or ("month",))).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("vw"), F.avg(value).alias("ew"), F.count("*").alias("n"))


def weights(monthly: DataFrame, weight: str = "cap_lag") -> DataFrame:
    """PF5: weights of each month, which sum to one."""
    ok = monthly.where(f"ret is not null and {weight} > 0")
    return ok.withColumn("weight", F.col(weight) / F.sum(weight).over(by("month")))


def daily_portfolios(panel: DataFrame) -> DataFrame:
    """PF6: daily means with the cap of the previous trading day of the whole panel, if the stock has a row there."""
    calendar = panel.groupBy("date").agg(F.lit(1).alias("_one"))
    calendar = calendar.select("date", F.row_number().over(by("_one", order="date")).alias("_k"))
    w = by("stock", order="date")
    p = panel.join(F.broadcast(calendar), "date").withColumn("cap_lag", F.when(F.col("_k") - F.lag("_k").over(w) == 1, F.lag("market_cap").over(w)))
    return portfolios(p, "date")


def rolling_fit(series: DataFrame, a: str, b: str, rows: int) -> DataFrame:
    """PF9: correlation and slope of two series over the last rows, once so many are there."""
    w = by("series", order="month").rowsBetween(-(rows - 1), 0)
    full = F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).over(w) == rows
    return series.withColumns({"corr": F.when(full, F.try_divide(F.covar_samp(a, b).over(w), F.nullif(F.stddev_samp(a).over(w) * F.stddev_samp(b).over(w), F.lit(0.0)))), "beta": F.when(full, F.try_divide(F.covar_samp(a, b).over(w), F.var_samp(b).over(w)))})


def universe_over_time(monthly: DataFrame) -> DataFrame:
    """PF12: per month: stocks, total cap, the largest weight with its stock, and the ten largest together."""
    w = weights(monthly).withColumn("_r", F.row_number().over(by("month", order=[F.desc("weight"), "stock"])))
    return w.groupBy("month").agg(F.count("*").alias("n"), F.sum("cap_lag").alias("cap"), F.max("weight").alias("max_weight"), F.max(F.when(F.col("_r") == 1, F.col("stock"))).alias("max_stock"), F.sum(F.when(F.col("_r") <= 10, F.col("weight"))).alias("top10"))


def cap_jumps(monthly: DataFrame, limit: float = 3.0) -> DataFrame:
    """PF15: months whose cap and price imply a change of the number of shares outside [1 / limit, limit]."""
    w = by("stock", order="month")
    shares = F.try_divide("market_cap", "close")
    m = monthly.withColumn("_s", shares).withColumn("change", F.try_divide("_s", F.lag("_s").over(w)))
    return m.where((F.col("change") > limit) | (F.col("change") < 1 / limit)).drop("_s")


def top_n(monthly: DataFrame, n: int) -> DataFrame:
    """EU8: value-weighted return of the n largest stocks by lagged cap."""
    ok = monthly.where("ret is not null and cap_lag > 0").withColumn("_r", F.row_number().over(by("month", order=[F.desc("cap_lag"), "stock"])))
    return portfolios(ok.where(F.col("_r") <= n))


def contributions(monthly: DataFrame, month: str, n: int) -> DataFrame:
    """EU9: the largest contributions to one month's value-weighted return."""
    m = weights(monthly.where(F.col("month") == F.lit(month).cast("date"))).withColumn("contribution", F.col("weight") * F.col("ret"))
    return m.orderBy(F.desc(F.abs("contribution")), "stock").limit(n)


def company_value(uni: DataFrame) -> DataFrame:
    """DER2: cap of all lines of a company in a month, one line for each ISIN (the largest); factor to the line, number of lines."""
    ok = uni.where("market_cap > 0 and company is not null")
    lines = first_rows(ok.withColumn("_k", F.when(F.length("isin") > 5, F.col("isin")).otherwise(F.col("stock").cast("string"))), ["company", "month", "_k"], [F.desc("market_cap"), "stock"])
    firm = lines.groupBy("company", "month").agg(F.sum("market_cap").alias("firm_cap"), F.count("*").cast("int").alias("n_lines"))
    out = uni.join(firm, ["company", "month"], "left")
    return out.withColumn("firm_factor", F.coalesce(F.greatest(F.try_divide("firm_cap", "market_cap"), F.lit(1.0)), F.lit(1.0)))


def dividend_yield(monthly: DataFrame) -> DataFrame:
    """DER3: sum over twelve rows of the positive part of total less price return; noise counts as zero."""
    part = F.greatest(F.col("ret") - F.col("retx"), F.lit(0.0))
    part = F.when(F.col("ret").isNotNull() & F.col("retx").isNotNull(), F.when(part <= 1e-10, 0.0).otherwise(part))
    return monthly.withColumn("_d", part).withColumn("dy_12m", full_frame(F.col("_d"), F.sum, by("stock", order="month"), 12)).drop("_d")


def threshold_flags(df: DataFrame, rules: dict[str, float | tuple[float, float]]) -> DataFrame:
    """PF16: each column as ok, CHECK or n/a by its rule: the least value, or a range with both ends."""
    flag = lambda c, r: F.when(F.col(c).isNull() | F.isnan(c), "n/a").when(F.col(c).between(*r) if isinstance(r, tuple) else F.col(c) >= r, "ok").otherwise("CHECK")
    return df.withColumns({c: flag(c, r) for c, r in rules.items()})
