"""Point-in-time fundamentals: report snapshots, previous reports, fiscal years, availability and attachment."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import add_months, log_of, months_between
from ledgerline.functions.frames import as_of, by, first_rows, island

def by_month():
    return by("stock", order="month")



def long_form(wide: DataFrame, items: list[str]) -> DataFrame:
    """(stock, month, variable, value) rows of the items that are known."""
    return wide.unpivot(["stock", "month"], items, "variable", "value").where("value is not null")


def wide_form(long: DataFrame, items: list[str]) -> DataFrame:
    """SRC13, PIT2: one row for each firm and month; equals the full outer join of all variables, in one shuffle."""
    return long.groupBy("stock", "month").pivot("variable", items).agg(F.max("value"))


def drop_negatives(wide: DataFrame, items: list[str]) -> DataFrame:
    """PIT3: negative values of items that cannot be negative become null."""
    return wide.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in items})


def clear_episodes(long: DataFrame, errors: DataFrame) -> DataFrame:
    """PIT3: from a flagged month (stock, variable, month) on, an item is null until its value changes."""
    w = by("stock", "variable", order="month")
    p = long.withColumn("_run", island(~F.coalesce(F.col("value") == F.lag("value").over(w), F.lag("value").over(w).isNull() & F.lag("month").over(w).isNotNull() & F.col("value").isNull()), w))
    p = p.join(errors.select("stock", "variable", "month", F.lit(True).alias("_hit")), ["stock", "variable", "month"], "left")
    from_hit = F.max("_hit").over(by("stock", "variable", "_run", order="month").rowsBetween(Window.unboundedPreceding, 0))
    return p.withColumn("value", F.when(from_hit.isNull(), F.col("value"))).drop("_run", "_hit")


def report_snapshots(wide: DataFrame, items: list[str]) -> DataFrame:
    """PIT4: the months in which a firm's first row stands, some item differs from the row before, or months are missing."""
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(by_month())) for c in items])
    gap = months_between(F.col("month"), F.lag("month").over(by_month())) > 1
    return wide.withColumn("_new", F.lag("month").over(by_month()).isNull() | differs | gap).where("_new").drop("_new").withColumnRenamed("month", "report_month")


def add_previous(snaps: DataFrame, items: list[str], min_gap: int = 9) -> DataFrame:
    """PIT5: the latest snapshot that is at least so many months older, its items with the suffix _prev."""
    left = snaps.withColumn("_until", add_months(F.col("report_month"), -min_gap))
    out = as_of(left, snaps, "stock", "_until", "report_month", items)
    prev = {f"{c}_prev": F.col("matched")[c] for c in items} | {"prev_report_month": F.col("matched")["report_month"]}
    return out.withColumns(prev).drop("matched", "_until")


def fiscal_year_end(snaps: DataFrame, stated: DataFrame | None = None, ahead: int = 23, rule: int = 11) -> DataFrame:
    """PIT6: the stated year end if it is 0 to `ahead` months after the report month, else report month + `rule`."""
    fallback = add_months(F.col("report_month"), rule)
    if stated is None:
        return snaps.withColumn("fye", fallback)
    s = snaps.join(stated.select("stock", F.col("month").alias("report_month"), F.last_day("fye").alias("_fye")), ["stock", "report_month"], "left")
    gap = months_between(F.col("_fye"), F.col("report_month"))
    return s.withColumn("fye", F.when(gap.between(0, ahead), F.col("_fye")).otherwise(fallback)).drop("_fye")


def availability(snaps: DataFrame, lag: int = 4, june: bool = False) -> DataFrame:
    """PIT7, EM5: first month of use: year end + lag, or June of the year after; the latest report wins a month."""
    when = F.last_day(F.make_date(F.year("fye") + 1, F.lit(6), F.lit(1))) if june else add_months(F.col("fye"), lag)
    return first_rows(snaps.withColumn("available", when), ["stock", "available"], [F.desc("report_month")])


def attach(universe: DataFrame, snaps: DataFrame, items: list[str], max_age: int = 18) -> DataFrame:
    """PIT8: each universe month with the latest available snapshot; too old a snapshot leaves nulls, not an older one."""
    out = as_of(universe, snaps, "stock", "month", "available", [*items, "fye", "report_month"])
    age = months_between(F.col("month"), F.col("matched")["fye"])
    out = out.withColumn("fund_age", age)
    fresh = F.col("fund_age") <= max_age
    return out.withColumns({c: F.when(fresh, F.col("matched")[c]) for c in [*items, "fye", "report_month"]}).withColumn("fund_age", F.when(fresh, F.col("fund_age"))).drop("matched")


@dataclass(frozen=True)
class BaselineConfig:
    """PIT9: months from the fiscal year's end to first use (or June of the year after), and the age that ends use."""

    lag: int = 4
    max_age: int = 18
    june: bool = False


def baseline(universe: DataFrame, snaps: DataFrame, items: list[str], config: BaselineConfig | None = None) -> DataFrame:
    """PIT7 to PIT9: the universe with the snapshots that a configuration makes available."""
    c = config or BaselineConfig()
    return attach(universe, availability(snaps, c.lag, c.june), items, c.max_age)


def coverage_by_year(df: DataFrame, items: list[str]) -> DataFrame:
    """PIT10: share of rows with a value, by year."""
    return df.groupBy(F.year("month").alias("year")).agg(F.count("*").alias("n"), *[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in items])


def lone_unit_errors(snaps: DataFrame, item: str, factor: float = 500.0) -> DataFrame:
    """EM1: a value more than `factor` times off both neighbours (or the only one) becomes null."""
    w = by("stock", order="report_month")
    x = F.when(F.col(item) > 0, F.col(item))
    s = snaps.withColumn("_x", x)
    off = lambda other: (F.col("_x") / other > factor) | (other / F.col("_x") > factor)
    before, after = F.lag("_x").over(w), F.lead("_x").over(w)
    bad = F.when(before.isNotNull() & after.isNotNull(), off(before) & off(after)).otherwise(F.coalesce(off(before), off(after), F.lit(False)))
    return s.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn(item, F.when(~F.col("_bad"), F.col(item))).drop("_x", "_bad")


def sales_by_fiscal_year(snaps: DataFrame) -> DataFrame:
    """EM3: (stock, fye, sales) of the latest snapshot of each fiscal year."""
    return first_rows(snaps, ["stock", "fye"], [F.desc("report_month")]).select("stock", "fye", "sales")


def emission_values(snaps: DataFrame, sales: DataFrame) -> DataFrame:
    """EM4: total (reported, else both scopes, else the estimate), its source, intensity on the year's sales, and log
    growth to the snapshot of the fiscal year 9 to 15 months before from the same kind of source."""
    latest = sales_by_fiscal_year(sales).withColumnRenamed("sales", "_sales")
    reported = F.coalesce("total", F.col("scope1") + F.col("scope2"))
    s = snaps.withColumn("emission", F.coalesce(reported, "estimate")).withColumn("estimated", F.when(F.col("emission").isNotNull(), reported.isNull()))
    s = s.join(latest, ["stock", "fye"], "left").withColumn("intensity", F.try_divide("emission", F.when(F.col("_sales") > 0, F.col("_sales")))).drop("_sales")
    right = first_rows(s, ["stock", "fye"], [F.desc("report_month")])
    out = as_of(s.withColumn("_until", add_months(F.col("fye"), -9)), right, "stock", "_until", "fye", ["emission", "estimated"])
    m = F.col("matched")
    ok = (months_between(F.col("fye"), m["fye"]) <= 15) & (m["estimated"] == F.col("estimated")) & (m["emission"] > 0)
    return out.withColumn("growth", F.when(ok, log_of(F.col("emission")) - F.log(m["emission"]))).drop("matched", "_until")


def report_events(wide: DataFrame, uni: DataFrame, items: list[str], nonneg: list[str] = (), stated: DataFrame | None = None) -> DataFrame:
    """AP7: all report snapshots of the universe's firms, without an availability lag, with the items of the previous report
    (9 months or more before) and the fiscal year end."""
    known = wide.join(uni.select("stock").distinct(), "stock", "left_semi").select("stock", "month", *items)
    return fiscal_year_end(add_previous(report_snapshots(drop_negatives(known, list(nonneg)), items), items), stated)


def availability_groups(wide: DataFrame, reported: list[str], scopes: list[str], estimate: str) -> DataFrame:
    """EC2: rows with some value, and which kind: any reported item, all scopes, estimated, either, only estimated."""
    has = lambda c: F.col(c).isNotNull()
    some, full = reduce(lambda a, b: a | b, map(has, reported)), reduce(lambda a, b: a & b, map(has, scopes))
    w = wide.where(some | full | has(estimate))
    return w.withColumns({"any_reported": some, "scope12_reported": full, "estimated": has(estimate), "reported_or_estimated": some | has(estimate), "estimated_only": has(estimate) & ~some})


def patched_ids(filtered: DataFrame, full: DataFrame, ids: list[str]) -> DataFrame:
    """EC16: company ids that the filtered statics lack, from the unfiltered ones; a line's first row there counts."""
    source = full.groupBy("stock").agg(*[F.min(c).alias(f"_{c}") for c in ids])
    out = filtered.join(source, "stock", "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") if c in filtered.columns else F.col(f"_{c}") for c in ids}).drop(*[f"_{c}" for c in ids])


def emission_coverage(df: DataFrame, month: int = 12) -> DataFrame:
    """EM7: each year's chosen month: stocks, reported, any; equally- and cap-weighted shares."""
    d = df.where(F.month("month") == month)
    cap = F.sum("market_cap")
    share = lambda c: F.sum(F.when(c, F.col("market_cap")).otherwise(0.0)) / cap
    rep, some = F.coalesce(~F.col("estimated"), F.lit(False)), F.col("emission").isNotNull()
    return d.groupBy(F.year("month").alias("year")).agg(F.count("*").alias("n"), F.count_if(rep).alias("n_reported"), F.count_if(some).alias("n_any"), F.avg(rep.cast("int")).alias("ew_reported"), share(rep).alias("vw_reported"), share(some).alias("vw_any"))


def stock_counts(df: DataFrame) -> DataFrame:
    """EM8: distinct stocks and stock-months by class: any value, reported, only estimated."""
    by_stock = df.where("emission is not null").groupBy("stock").agg(F.count("*").alias("n"), F.count_if(~F.col("estimated")).alias("r"))
    return by_stock.agg(F.count("*").alias("stocks"), F.sum("n").alias("months"), F.count_if(F.col("r") > 0).alias("stocks_reported"), F.sum("r").alias("months_reported"), F.count_if(F.col("r") == 0).alias("stocks_only_estimated"))


def industry_adjusted(df: DataFrame, value: str, industry: str, name: str, least: int = 5) -> DataFrame:
    """SD2: log value less the median of its month and industry, null under so many values."""
    d = df.withColumn("_x", log_of(F.col(value)))
    mid = d.where("_x is not null").groupBy("month", industry).agg(F.median("_x").alias("_m"), F.count("*").alias("_n"))
    return d.join(mid, ["month", industry], "left").withColumn(name, F.when(F.col("_n") >= least, F.col("_x") - F.col("_m"))).drop("_x", "_m", "_n")


def controls(df: DataFrame) -> DataFrame:
    """DER6: leverage, investment, return on equity, sales growth, and volatility of twelve known returns."""
    from ledgerline.functions.frames import full_frame

    d = df.withColumns({"leverage": F.try_divide("debt", "assets"), "roe": F.when(F.col("equity") > 0, F.try_divide("income", "equity")), "sales_growth": log_of(F.try_divide("sales", "sales_prev"))})
    return d.withColumn("vol_12m", full_frame(F.col("ret"), F.stddev_samp, by("stock", order="month"), 12))
