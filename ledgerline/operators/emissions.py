"""Emission tables: overview of the raw items, coverage on yearly cross-sections, reported beside estimated values, example firms.

A wide table has (stock, month) and a column for each item; the universe (stock, month, market_cap, size_group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import months_between
from ledgerline.functions.frames import as_of, by
from ledgerline.operators.checks import firm_years
from ledgerline.operators.pit import availability_groups, lone_unit_errors

GROUPS = ("any_reported", "scope12_reported", "estimated", "reported_or_estimated", "estimated_only")


def raw_overview(p: DataFrame, registered: DataFrame, firms: tuple[int, int] = (100, 500)) -> DataFrame:
    """EC1: for each registered variable, also those without data: firms, firm-months, first and last month, the first years with so
    many firms, median number of distinct values of a firm, shares of zero and negative values, three quantiles."""
    per_year = firm_years(p).groupBy("variable", "year").agg(F.count("*").alias("_k"))
    years = per_year.groupBy("variable").agg(*[F.min(F.when(F.col("_k") >= n, F.col("year"))).alias(f"first_year_{n}_firms") for n in firms])
    kinds = p.groupBy("variable", "stock").agg(F.count_distinct("value").alias("_k")).groupBy("variable").agg(F.median("_k").alias("median_distinct_values"))
    share = lambda c: F.avg(c.cast("int"))
    whole = p.groupBy("variable").agg(
        F.count_distinct("stock").alias("firms"), F.count("*").alias("firm_months"), F.min("month").alias("first"), F.max("month").alias("last"), share(F.col("value") == 0).alias("share_zero"), share(F.col("value") < 0).alias("share_negative"),
        *[F.percentile("value", F.lit(q)).alias(n) for q, n in ((0.01, "p01"), (0.5, "p50"), (0.99, "p99"))],
    )
    out = registered.select("variable").distinct()
    for part in (whole, years, kinds):
        out = out.join(part, "variable", "left")
    return out.fillna(0, ["firms", "firm_months"])


def cross_sections(wide: DataFrame, uni: DataFrame, items: dict[str, str | list[str]], month: int = 12) -> DataFrame:
    """The universe's rows of one month of each year with the wide table's items and availability groups (false without a row)."""
    known = availability_groups(wide, items["reported"], items["scopes"], items["estimate"])
    m = uni.where(F.month("month") == month).join(known, ["stock", "month"], "left")
    return m.withColumn("year", F.year("month")).fillna(False, list(GROUPS))


def coverage_by_year(wide: DataFrame, uni: DataFrame, items: dict[str, str | list[str]], month: int = 12) -> DataFrame:
    """EC3: for each year's cross-section and each item and group: stocks of the universe, their cap in billions, those with a value,
    and their equally- and cap-weighted shares."""
    values = list(dict.fromkeys([*items["reported"], *items["scopes"], items["estimate"]]))
    has = [F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().alias("has")) for c in values] + [F.struct(F.lit(g).alias("field"), F.col(g).alias("has")) for g in GROUPS]
    m = cross_sections(wide, uni, items, month).select("year", "market_cap", F.explode(F.array(*has)).alias("f")).select("year", "market_cap", "f.*")
    cap = F.sum("market_cap")
    return m.groupBy("year", "field").agg(F.count("*").alias("n_universe"), (cap / 1000).alias("cap_bn"), F.count_if("has").alias("n"), F.avg(F.col("has").cast("int")).alias("ew"), (F.sum(F.when(F.col("has"), F.col("market_cap")).otherwise(0.0)) / cap).alias("vw"))


def coverage_by_size(wide: DataFrame, uni: DataFrame, items: dict[str, str | list[str]], group: str = "reported_or_estimated", month: int = 12, first_year: int = 2000) -> DataFrame:
    """EC4: share of each size group's stocks that are in an availability group, by year."""
    m = cross_sections(wide, uni.where(F.year("month") >= first_year).where("size_group is not null"), items, month)
    return m.groupBy("year", "size_group").agg(F.avg(F.col(group).cast("int")).alias("share"), F.count("*").alias("n"))


def firm_counts(wide: DataFrame, uni: DataFrame, items: dict[str, str | list[str]], first_year: int = 2002) -> DataFrame:
    """EC4: stocks of the universe since a year, ever in each availability group, and how many of their yearly cross-sections are."""
    u = uni.where(F.year("month") >= first_year)
    stocks = u.select("stock").distinct()
    cells = lambda d: d.select("stock", F.explode(F.array(F.lit("universe"), *[F.when(F.col(g), F.lit(g)) for g in GROUPS])).alias("group")).where("group is not null")
    years = cells(cross_sections(wide, u, items)).groupBy("group").agg(F.count("*").alias("stock_years"))
    known = availability_groups(wide, items["reported"], items["scopes"], items["estimate"]).join(stocks, "stock", "left_semi")
    ever = cells(known).where("group <> 'universe'").unionByName(stocks.withColumn("group", F.lit("universe"))).groupBy("group").agg(F.count_distinct("stock").alias("stocks"))
    out = ever.join(years, "group", "full").fillna(0)
    return out.join(F.broadcast(stocks.agg(F.count("*").alias("_all")))).withColumn("share", F.col("stocks") / F.col("_all")).drop("_all")  # one row


def reported_vs_estimated(wide: DataFrame, total: str, estimate: str, tolerance: float = 0.001, month: int = 12) -> DataFrame:
    """EC11: on each year's cross-section: rows with the reported total only, the estimate only, both; where both are there, the share of
    estimates equal to the total, and the spread of estimate / total (positive totals)."""
    t, e = F.col(total), F.col(estimate)
    d = wide.where(F.month("month") == month).where(t.isNotNull() | e.isNotNull())
    both = t.isNotNull() & e.isNotNull()
    d = d.withColumns({"_both": both, "_ratio": F.when(both & (t > 0), e / t)})
    equal = F.when(F.col("_both"), F.coalesce(F.abs(F.col("_ratio") - 1) <= tolerance, F.lit(False)).cast("int"))
    quantile = lambda q: F.percentile("_ratio", F.lit(q))
    return d.groupBy(F.year("month").alias("year")).agg(F.count_if(e.isNull()).alias("reported_only"), F.count_if(t.isNull()).alias("estimated_only"), F.count_if("_both").alias("both"), F.avg(equal).alias("share_equal"), quantile(0.5).alias("median"), quantile(0.1).alias("p10"), quantile(0.9).alias("p90"))


def example_firms(statics: DataFrame, uni: DataFrame, patterns: DataFrame) -> DataFrame:
    """EC14: for each pattern the firm with the largest cap ever whose name holds it."""
    size = uni.groupBy("stock").agg(F.max("market_cap").alias("cap")).where("cap is not null")
    x = size.join(statics.select("stock", "ename"), "stock").join(patterns, F.expr("contains(upper(ename), pattern)"))
    return x.groupBy("pattern").agg(F.max_by(F.struct("stock", "ename", "cap"), F.struct("cap", -F.col("stock"))).alias("f")).select("pattern", "f.*")


def example_events(wide: DataFrame, reports: DataFrame, examples: DataFrame, fye_month: DataFrame, from_year: int = 2015) -> DataFrame:
    """EC14: for the example firms, every month from a year on in which an item or the accounts (reports: stock, month) change: the
    items after the change (null where only the accounts do), the names of the changed ones, whether the accounts change, and
    the month of the fiscal year end. The few examples select the rows first; all else happens on these."""
    items = [c for c in wide.columns if c not in ("stock", "month")]
    few = examples.select("stock", F.col("ename").alias("firm")).distinct()
    w = by("stock", order="month")
    d = wide.join(few.select("stock"), "stock", "left_semi")
    changed = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.lag(c).over(w)), F.lit(c)) for c in items]))
    d = d.withColumn("changed", changed).where(F.size("changed") > 0).withColumn("changed", F.array_join("changed", ","))
    r = reports.select("stock", "month").distinct().join(wide.select("stock").distinct(), "stock", "left_semi").withColumn("accounts", F.lit(True))
    out = d.join(r.join(few.select("stock"), "stock", "left_semi"), ["stock", "month"], "full").where(F.year("month") >= from_year)
    return out.join(few, "stock").join(fye_month.select("stock", "fye_month"), "stock", "left").fillna({"changed": "", "accounts": False})


def report_months(changes: DataFrame) -> DataFrame:
    """EC5: months in which some item of a firm's accounts changes, from change events (QC2)."""
    return changes.select("stock", "month").distinct()


def lag_to_reports(events: DataFrame, reports: DataFrame, most: int = 6) -> DataFrame:
    """EC7: months from the latest report to each event, lags of `most` or more in one bin: counts and shares; null without a report."""
    a = as_of(events.select("stock", "month"), reports.select("stock", F.col("month").alias("report")), "stock", "month", "report", [])
    lag = F.least(months_between(F.col("month"), F.col("matched")["report"]), F.lit(most)).cast("double")
    g = a.groupBy(lag.alias("lag")).agg(F.count("*").alias("n")).withColumn("_one", F.lit(1))
    return g.withColumn("share", F.col("n") / F.sum("n").over(by("_one"))).drop("_one")


def identity_by_year(wide: DataFrame, total: str, parts: Column, tolerance: float) -> DataFrame:
    """EC10: rows with a positive total and all parts by year: median of total / parts, and the share within the tolerance of 1."""
    w = wide.where(F.col(total) > 0).withColumn("_r", F.try_divide(F.col(total), parts)).where("_r is not null")
    return w.groupBy(F.year("month").alias("year")).agg(F.count("*").alias("n"), F.median("_r").alias("median_ratio"), F.avg((F.abs(F.col("_r") - 1) <= tolerance).cast("int")).alias("within"))


def share_classes(wide: DataFrame, companies: DataFrame, value: str) -> DataFrame:
    """EC13: company-months with several lines: how many, the share in which all lines have one same value, and in which only some have one."""
    x = wide.join(companies.select("stock", "company"), "stock").groupBy("company", "month").agg(F.count("*").alias("lines"), F.count(value).alias("known"), F.count_distinct(value).alias("kinds")).where("lines > 1")
    return x.agg(F.count("*").alias("groups"), F.avg(F.expr("kinds = 1 and known = lines").cast("int")).alias("identical"), F.avg(F.expr("known between 1 and lines - 1").cast("int")).alias("partly"))


def clean_snapshots(snaps: DataFrame, total: str, items: list[str]) -> DataFrame:
    """EM2: snapshots with lone unit errors of the total cleared; those without any item go."""
    return lone_unit_errors(snaps, total).where(F.coalesce(*items).isNotNull())


def sustainability_dataset(emissions: DataFrame, fundamentals: DataFrame, statics: DataFrame, financial: Column) -> DataFrame:
    """SD3: emission rows with their log, the fundamentals of the month, country and whether the firm is financial."""
    d = emissions.where("emission is not null").join(fundamentals, ["stock", "month"], "left").join(statics.select("stock", "country", financial.alias("is_financial")), "stock", "left")
    return d.withColumn("log_emission", F.when(F.col("emission") > 0, F.log("emission")))


def summary_by_year(emissions: DataFrame, statics: DataFrame, financial: Column, month: int = 12) -> DataFrame:
    """SD4: each year's cross-section: rows, reported ones, financial firms, and the median intensity of the others."""
    d = emissions.where(F.col("emission").isNotNull() & (F.month("month") == month)).join(statics.select("stock", financial.alias("_f")), "stock")
    return d.groupBy(F.year("month").alias("year")).agg(F.count("*").alias("n"), F.count_if(~F.col("estimated")).alias("reported"), F.count_if("_f").alias("financial"), F.median(F.when(~F.col("_f"), F.col("intensity"))).alias("median_intensity"))


def report_tables(wide: DataFrame, uni: DataFrame, sized: DataFrame, reports: DataFrame, statics: DataFrame, patterns: DataFrame, fye_month: DataFrame, items: dict[str, str | list[str]], first_year: int = 2002) -> dict[str, DataFrame]:
    """EC16: all tables of the emission report, by name; nothing runs before they are read or written."""
    long = wide.unpivot(["stock", "month"], [c for c in wide.columns if c not in ("stock", "month")], "variable", "value").where("value is not null")
    registered = long.select("variable").distinct()
    examples = example_firms(statics, uni, patterns)
    return {
        "raw_overview": raw_overview(long, registered), "coverage_by_year": coverage_by_year(wide, uni, items), "coverage_by_size": coverage_by_size(wide, sized, items, first_year=first_year), "firm_counts": firm_counts(wide, uni, items, first_year),
        "reported_vs_estimated": reported_vs_estimated(wide, items["reported"][0], items["estimate"]), "share_classes": share_classes(wide, statics, items["reported"][0]), "example_firms": examples,
        "example_events": example_events(wide, reports, examples, fye_month, first_year),
    }


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """EC16: (table, rows) of a report's tables, as one frame."""
    out = None
    for name, d in tables.items():
        one = d.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
