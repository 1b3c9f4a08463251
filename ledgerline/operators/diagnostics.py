"""Diagnostics of values against each other: book values and market-to-book by line, bases of share counts, sparse classifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import add_months
from ledgerline.functions.frames import by

# Irrevocable conversion rates of legacy currencies to the euro, by the code of a line's currency.
EURO_RATES = {
    "AS": 13.7603, "BF": 40.3399, "LF": 40.3399, "DM": 1.95583, "EP": 166.386, "FF": 6.55957, "£E": 0.787564, "L": 1936.27, "FL": 2.20371, "PE": 200.482, "M": 5.94573, "DR": 340.750,
    "TO": 239.640, "CY": 0.585274, "M£": 0.429300, "KK": 30.1260, "EK": 15.6466, "LV": 0.702804, "LT": 3.45280, "KA": 7.53450, "BL": 1.95583,
}
# Words of a name that tell share classes apart, and the words that begin a line's status.
CLASS_WORDS = ("A", "B", "C", "D", "R", r"SER\.?", "SERIES", r"PREF\.?", "PREFERENCE", "RSP", "RNC", "RCV", r"RISP\.?", "SAVINGS", "VZ", "ST", "PC", "NV", "CI", "CIP", "ADP", "AFV", "AGRISES", "PV", "BEARER", "REGISTERED", "'A'", "'B'", "'C'")
STATUS_WORDS = ("DEAD", "EXPIRED", "SUSP")


def name_stem(name: Column, words: int = 3) -> Column:
    """The first words of a name in upper case, without status, class words and signs: lines of one company share it."""
    n = F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), rf"\s+({'|'.join(STATUS_WORDS)})\b.*$", "")
    n = F.regexp_replace(F.regexp_replace(n, rf"\b({'|'.join(CLASS_WORDS)})\b", " "), "[^A-Z0-9 ]", " ")
    return F.array_join(F.slice(F.array_remove(F.split(n, " +"), ""), 1, words), " ")


def value_consistency(rows: DataFrame, currencies: DataFrame, rates: dict[str, float] = EURO_RATES, tolerance: float = 0.03) -> DataFrame:
    """DG1: for each line (stock, country, name) the median of mtbv * bm where positive, its months and 10 % quantiles, and why it is not near 1:
    ok; legacy_currency (the ratio is one over the rate of the line's currency); share_class (above 1, and another line of
    the country has the same name stem); other. rows: (stock, country, name, month, mtbv, bm), currencies: (stock, currency)."""
    ratio = F.col("mtbv") * F.col("bm")
    lines = rows.withColumn("_r", ratio).where("_r > 0").groupBy("stock", "country", "name").agg(F.median("_r").alias("ratio"), F.count("*").alias("months"), F.percentile("_r", F.lit(0.1)).alias("q10"), F.percentile("_r", F.lit(0.9)).alias("q90"))
    stems = rows.groupBy("stock").agg(F.min_by(F.struct("country", name_stem(F.col("name")).alias("stem")), "month").alias("s")).select("stock", "s.*")
    # A stem's lines are counted before they meet, so that a frequent one is a row.
    several = stems.groupBy("country", "stem").agg(F.count("*").alias("_k")).where("_k > 1")
    shared = stems.join(several, ["country", "stem"], "left_semi").select("stock", F.lit(True).alias("_shared"))
    rate = F.coalesce(*[F.when(F.col("currency") == c, F.lit(v)) for c, v in rates.items()]) if rates else F.lit(None).cast("double")
    out = lines.join(currencies.select("stock", "currency"), "stock", "left").join(shared, "stock", "left").withColumn("_rate", rate)
    category = F.when(F.col("ratio").between(0.95, 1.05), "ok").when(F.abs(F.col("ratio") * F.col("_rate") - 1) < tolerance, "legacy_currency").when((F.col("ratio") > 1.05) & F.col("_shared"), "share_class").otherwise("other")
    return out.withColumn("category", category).withColumn("expected_legacy_ratio", 1 / F.col("_rate")).drop("_rate", "_shared")


def odd_lines(consistency: DataFrame) -> DataFrame:
    """DG1: lines that are not ok by country and category."""
    return consistency.where("category <> 'ok'").groupBy("country", "category").agg(F.count("*").alias("lines"))


BASES = ("unadjusted", "adjusted", "adjusted_now")


def shares_ratios(b: DataFrame) -> DataFrame:
    """DG4: (stock, month, country, basis, r): reported shares over those that cap and price give, on three bases: unadjusted and adjusted price
    at the fiscal year end (the month before report_month), adjusted price of the row's month. A country's ratios on one basis
    are freed of the power of ten nearest to their median. b: (stock, month, country, market_cap, price, price_unadjusted, shares,
    report_month), unique by (stock, month)."""
    look = b.select("stock", F.col("month").alias("fye"), F.col("market_cap").alias("_cap"), F.col("price").alias("_p"), F.col("price_unadjusted").alias("_u"))
    x = b.where("report_month is not null and shares is not null").withColumn("fye", add_months(F.col("report_month"), -1)).join(look, ["stock", "fye"])
    ratio = lambda cap, price: F.try_divide(F.col("shares") * F.col(price), F.col(cap))
    cells = F.array(*[F.struct(F.lit(n).alias("basis"), r.alias("r")) for n, r in zip(BASES, (ratio("_cap", "_u"), ratio("_cap", "_p"), ratio("market_cap", "price")), strict=True)])
    x = x.select("stock", "month", "country", F.explode(cells).alias("c")).select("stock", "month", "country", "c.*").withColumn("r", F.when((F.col("r") > 0) & (F.col("r") < float("inf")), F.col("r")))
    scale = x.groupBy("country", "basis").agg(F.pow(F.lit(10.0), F.round(F.log10(F.median("r")))).alias("_s"))
    return x.join(scale, ["country", "basis"]).withColumn("r", F.col("r") / F.col("_s")).drop("_s")


def shares_basis(ratios: DataFrame) -> DataFrame:
    """DG4: for each basis: lines, shares of their medians within 5 %, above and below, and share of rows within 5 %."""
    lines = ratios.groupBy("basis", "stock").agg(F.median("r").alias("m"))
    share = lambda c, name: F.avg(F.coalesce(c, F.lit(False)).cast("int")).alias(name)
    m = F.col("m")
    one = lines.groupBy("basis").agg(F.count("m").alias("lines"), share(m.between(0.95, 1.05), "within"), share(m > 1.05, "above"), share(m < 0.95, "below"))
    return one.join(ratios.groupBy("basis").agg(share(F.col("r").between(0.95, 1.05), "rows_within")), "basis")


def shares_basis_by_country(ratios: DataFrame) -> DataFrame:
    """DG4: share of a country's rows within 5 % on each basis."""
    return ratios.groupBy("country", "basis").agg(F.avg(F.coalesce(F.col("r").between(0.95, 1.05), F.lit(False)).cast("int")).alias("rows_within"))


def field_combinations(months: DataFrame, statics: DataFrame, fields: list[str]) -> DataFrame:
    """DG2: stocks of each group by the fields that they have, as names joined by `+` (empty: none). months: (stock, groups)."""
    s = months.select("stock", F.explode("groups").alias("group")).distinct().join(statics.select("stock", *fields), "stock", "left")
    have = F.array_join(F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields])), "+")
    return s.groupBy("group", have.alias("fields")).agg(F.count("*").alias("stocks"))


def granularity(months: DataFrame, statics: DataFrame, fields: list[str]) -> DataFrame:
    """DG2: for each group and field, in one pass of grouping sets: categories, and those with under 5 and under 10 stocks."""
    s = months.select("stock", F.explode("groups").alias("group")).distinct().join(statics.select("stock", *fields), "stock")
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("category")) for f in fields])
    c = s.select("group", F.explode(cells).alias("c")).select("group", "c.*").where("category is not null").groupBy("group", "field", "category").agg(F.count("*").alias("n"))
    return c.groupBy("group", "field").agg(F.count("*").alias("categories"), F.count_if(F.col("n") < 5).alias("under_5"), F.count_if(F.col("n") < 10).alias("under_10"))


def largest_unclassified(months: DataFrame, statics: DataFrame, field: str, group: str, n: int = 25) -> DataFrame:
    """DG2: the n stocks of a group with the largest cap ever that lack a field."""
    size = months.where(F.array_contains("groups", group)).groupBy("stock").agg(F.max("market_cap").alias("cap"))
    x = size.join(statics.where(F.col(field).isNotNull()).select("stock"), "stock", "left_anti").where("cap is not null")
    x = x.orderBy(F.desc("cap"), "stock").limit(n).withColumn("_one", F.lit(1))
    return x.withColumn("rank", F.row_number().over(by("_one", order=[F.desc("cap"), "stock"]))).drop("_one")
