"""Quality battery of variables, all at once: a long panel (variable, stock, month, value) with `variable` as leading key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import log_of, months_between
from ledgerline.functions.frames import as_of, by, correlation, first_rows, island, spread_rank
from ledgerline.functions.tables import bucketed

def _series():
    return by("variable", "stock", order="month")



def prepare(raw: DataFrame) -> DataFrame:
    """QC1: known values by month end, one for each firm-month; the latest date of a month wins."""
    p = raw.where("value is not null").withColumn("month", F.last_day("date"))
    return first_rows(p, ["variable", "stock", "month"], [F.desc("date"), "value"]).drop("date")


def change_events(p: DataFrame) -> DataFrame:
    """QC2: observations that differ from the firm's one before."""
    return p.withColumn("prev", F.lag("value").over(_series())).where("prev is not null and value <> prev")


def firm_years(p: DataFrame) -> DataFrame:
    """QC3: the last value of each firm and year."""
    return p.groupBy("variable", "stock", F.year("month").alias("year")).agg(F.max_by("value", "month").alias("value"))


def coverage(p: DataFrame, uni: DataFrame, *keys: str) -> DataFrame:
    """For each variable and group of universe rows (month and further keys): stocks, those with a value, and their market caps.

    The universe is counted once and the values once; only the counts, a row for each group, are paired with the variables."""
    at = ["month", *keys]
    whole = uni.groupBy(*at).agg(F.count("*").alias("n"), F.sum("market_cap").alias("cap"))
    hits = p.select("variable", "stock", "month").join(uni.select("stock", "market_cap", *at), ["stock", "month"]).groupBy("variable", *at).agg(F.count("*").alias("n_value"), F.sum("market_cap").alias("cap_value"))
    return whole.join(p.select("variable").distinct()).join(hits, ["variable", *at], "left").fillna(0, ["n_value"])


def in_universe(p: DataFrame, uni: DataFrame) -> DataFrame:
    """QC4: the observations whose stock is in the universe in that month."""
    return p.join(uni.select("stock", "month"), ["stock", "month"], "left_semi")


def coverage_by_size(p: DataFrame, sized: DataFrame, groups: int) -> DataFrame:
    """QC6: mean of monthly coverage by year, a column for each size group; rows without a group do not count."""
    m = coverage(p, sized.where("size_group is not null"), "size_group").withColumn("_s", F.col("n_value") / F.col("n"))
    out = m.groupBy("variable", F.year("month").alias("year")).pivot("size_group", list(range(1, groups + 1))).agg(F.avg("_s"))
    return out.select("variable", "year", *[F.col(f"`{k}`").alias(f"group_{k}") for k in range(1, groups + 1)])


def december_panel(wide: DataFrame, uni: DataFrame, month: int = 12) -> DataFrame:
    """QC18: the universe's rows of one month of each year with the variables."""
    return uni.where(F.month("month") == month).join(wide.where(F.month("month") == month), ["stock", "month"])


def january_growth(p: DataFrame, month: int = 1) -> DataFrame:
    """DG3: number and median log growth of the updates in one month of each year, of positive values."""
    e = change_events(p).where(F.month("month") == month)
    growth = F.when((F.col("value") > 0) & (F.col("prev") > 0), log_of(F.try_divide("value", "prev")))
    return e.groupBy("variable", F.year("month").alias("year")).agg(F.count("*").alias("n"), F.median(growth).alias("median_growth"))


def values_at(p: DataFrame, stocks: list, months: list[str]) -> DataFrame:
    """DG3: the values of a few firms in a few months, as a column for each month."""
    rows = p.where(F.col("stock").isin(stocks)).withColumn("_m", F.date_format("month", "yyyy-MM"))
    return rows.where(F.col("_m").isin(months)).groupBy("variable", "stock").pivot("_m", months).agg(F.first("value"))


def coverage_by_month(p: DataFrame, uni: DataFrame) -> DataFrame:
    """QC5: for each variable and universe month: stocks and their caps, those with a value and theirs, both shares, and the month's
    observations outside the universe. Uni is unique by (stock, month)."""
    return monthly_coverage(with_universe(p, uni), uni)


def with_universe(p: DataFrame, uni: DataFrame) -> DataFrame:
    """The panel with what the universe says of each row: in_universe, market_cap, and the stock's first_price, last_price and (if
    uni has it) delisting_date. Both sides are put together and meet in windows over one exchange by stock."""
    u = uni.select("stock", "month", "market_cap", *[c for c in ("delisting_date",) if c in uni.columns], F.lit(True).alias("_u"))
    both = p.select("variable", "stock", "month", "value").unionByName(u, allowMissingColumns=True).repartition("stock")
    here, own = by("stock", "month"), by("stock")
    known = F.when(F.col("_u"), F.col("month"))
    both = both.withColumns({"in_universe": F.coalesce(F.bool_or("_u").over(here), F.lit(False)), "market_cap": F.max("market_cap").over(here), "first_price": F.min(known).over(own), "last_price": F.max(known).over(own)})
    if "delisting_date" in both.columns:
        both = both.withColumn("delisting_date", F.max("delisting_date").over(own))
    return both.where("variable is not null").drop("_u")


def monthly_coverage(f: DataFrame, uni: DataFrame) -> DataFrame:
    """QC5 of a panel `with_universe`."""
    hits = f.groupBy("variable", "month").agg(F.count_if("in_universe").alias("n_value"), F.sum(F.when(F.col("in_universe"), F.col("market_cap"))).alias("cap_value"), F.count_if(~F.col("in_universe")).alias("n_outside"))
    whole = uni.groupBy("month").agg(F.count("*").alias("n"), F.sum("market_cap").alias("cap"))
    grid = whole.join(f.select("variable").distinct()).join(hits, ["variable", "month"], "left").fillna(0, ["n_value", "n_outside"]).fillna(0.0, ["cap_value"])
    return grid.select("variable", "month", "n", "n_value", "cap", "cap_value", (F.col("n_value") / F.col("n")).alias("ew"), F.try_divide("cap_value", "cap").alias("vw"), "n_outside")


def history(p: DataFrame) -> DataFrame:
    """QC8: firms, observations, months spanned, firms with gaps."""
    f = p.groupBy("variable", "stock").agg(F.count("*").alias("n"), (months_between(F.max("month"), F.min("month")) + 1).alias("span"))
    return f.groupBy("variable").agg(F.count("*").alias("firms"), F.sum("n").alias("obs"), F.sum("span").alias("months"), F.count_if(F.col("span") > F.col("n")).alias("firms_with_gaps"))


def history_shares(p: DataFrame) -> DataFrame:
    """QC8: for each variable: firms, their median number of months, share of firms with gaps, share of months in gaps."""
    f = p.groupBy("variable", "stock").agg(F.count("*").alias("n"), (months_between(F.max("month"), F.min("month")) + 1).alias("span"))
    return f.groupBy("variable").agg(F.count("*").alias("firms"), F.median("n").alias("median_months"), F.avg((F.col("span") > F.col("n")).cast("int")).alias("share_with_gaps"), (F.sum(F.col("span") - F.col("n")) / F.sum("span")).alias("share_gap_months"))


def matching(p: DataFrame, uni: DataFrame) -> DataFrame:
    """QC9: for each variable: its firms, those of the universe in its own period, those in both, and both shares."""
    spans = p.groupBy("variable").agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    mine = p.select("variable", "stock").distinct().withColumn("_v", F.lit(1))
    # A row for each variable: broadcast by its nature.
    inside = uni.select("stock", "month").join(F.broadcast(spans), F.col("month").between(F.col("_a"), F.col("_b"))).select("variable", "stock").distinct().withColumn("_u", F.lit(1))
    j = mine.join(inside, ["variable", "stock"], "full").groupBy("variable").agg(F.count("_v").alias("firms"), F.count("_u").alias("universe"), F.count(F.col("_v") + F.col("_u")).alias("both"))
    return j.withColumns({"share_in_universe": F.col("both") / F.greatest("firms", F.lit(1)), "share_covered": F.col("both") / F.greatest("universe", F.lit(1))})


def update_frequency(p: DataFrame, least: int = 12) -> DataFrame:
    """QC10: by year, shares of firm-years with 0, 1, 2-3, 4 and 5 or more changes, among those with enough months, and the median."""
    y = p.withColumn("_new", F.lag("value").over(_series())).groupBy("variable", "stock", F.year("month").alias("year"))
    j = y.agg(F.count("*").alias("n"), F.count_if(F.col("_new") != F.col("value")).alias("changes")).where(F.col("n") >= least)
    share = lambda cond, name: F.avg(cond.cast("int")).alias(name)
    k = F.col("changes")
    bins = [share(k == 0, "none"), share(k == 1, "one"), share(k.between(2, 3), "two_three"), share(k == 4, "four"), share(k >= 5, "more")]
    return j.groupBy("variable", "year").agg(F.count("*").alias("firm_years"), *bins, F.median("changes").alias("median"))


def reporting_lag(p: DataFrame, fye_month: DataFrame) -> DataFrame:
    """QC11, EC8: months from the fiscal year end to a change, modulo twelve: counts and shares."""
    e = change_events(p).join(fye_month, "stock").withColumn("lag", F.pmod(F.month("month") - F.col("fye_month"), F.lit(12)).cast("int"))
    g = e.groupBy("variable", "lag").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(by("variable")))


def stale_runs(p: DataFrame, run: int = 24) -> DataFrame:
    """QC12: firms with a run of equal values, other than zero and zero, of more than `run` months."""
    r = p.withColumn("_r", island(F.lag("value").over(_series()).isNull() | (F.col("value") != F.lag("value").over(_series())), _series()))
    r = r.groupBy("variable", "stock", "_r").agg(F.count("*").alias("n"), F.first("value").alias("value")).where(F.col("n") > run)
    return r.groupBy("variable").agg(F.count_distinct(F.when(F.col("value") != 0, F.col("stock"))).alias("firms_stale"), F.count_distinct(F.when(F.col("value") == 0, F.col("stock"))).alias("firms_zero"), F.max("n").alias("longest"))


def padding_and_staleness(p: DataFrame, uni: DataFrame, life: DataFrame, run: int = 24, months: int = 12) -> DataFrame:
    """QC12: values beside the life of a stock, and stale values, as shares for each variable; `life` has (stock, first_price,
    last_price, delisting_date) of each stock, `uni` its months."""
    f = with_universe(p, uni.withColumn("market_cap", F.lit(None).cast("double"))).drop("market_cap", "first_price", "last_price", "delisting_date")
    return staleness(f.join(life, "stock", "left"), uni, run, months)


def staleness(f: DataFrame, uni: DataFrame, run: int = 24, months: int = 12) -> DataFrame:
    """QC12 of a panel `with_universe`, with delisting dates.

    Shares after the last and before the first price and after delisting are of the rows of known stocks. A row is stale from the
    run + 1st equal value on, other than zero; while-trading shares are of the rows in the universe. A dead firm (its last
    price is before the universe ends) is padded if a value stands more than `months` months after it."""
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    w = _series()
    r = f.withColumn("_r", island(F.lag("value").over(w).isNull() | (F.col("value") != F.lag("value").over(w)), w))
    r = r.withColumn("_long", F.row_number().over(by("variable", "stock", "_r", order="month")) > run)
    r = r.join(F.broadcast(uni.agg(F.max("month").alias("_end"))))  # one row
    after = F.when(F.col("last_price").isNotNull(), F.col("month") > F.col("last_price"))
    zero, alive = F.col("value") == 0, F.col("in_universe")
    firm = r.groupBy("variable", "stock").agg(
        F.count("*").alias("n"), F.count("last_price").alias("m"), F.count_if(after).alias("after"), F.count_if(F.col("month") < F.col("first_price")).alias("before"),
        F.count_if(F.col("month") > F.last_day("delisting_date")).alias("delisted"), F.count_if(F.col("_long") & ~zero).alias("stale"), F.count_if(alive).alias("alive"),
        F.count_if(F.col("_long") & ~zero & alive).alias("stale_alive"), F.count_if(F.col("_long") & zero & alive).alias("zero_alive"),
        F.bool_or(F.when(F.col("last_price") < F.col("_end"), months_between(F.col("month"), F.col("last_price")) > months)).alias("padded"),
    )
    part = lambda a, b: F.try_divide(F.sum(a), F.sum(b))
    living = lambda a: F.sum(a) / F.greatest(F.sum("alive"), F.lit(1))
    return firm.groupBy("variable").agg(
        F.sum("m").alias("matched"), F.avg(F.col("padded").cast("int")).alias("dead_padded"), part("after", "m").alias("after_last_price"), part("delisted", "m").alias("after_delisting"), part("before", "m").alias("before_first_price"),
        part("stale", "n").alias("stale"), living("stale_alive").alias("stale_trading"), living("zero_alive").alias("zero_runs_trading"), share(F.col("stale_alive") > 0).alias("firms_stale"),
    )


def unit_jumps(p: DataFrame, hard: float = 2.5, soft: float = 0.9, months: int = 24, tolerance: float = 0.3) -> DataFrame:
    """QC13: changes between positive values by a factor of 10**hard, or of 10**soft if undone within some months; the one that
    undoes is not counted. `type` is jump or reversal."""
    e = change_events(p).where("value > 0 and prev > 0").withColumn("step", F.log10(F.col("value") / F.col("prev")))
    undone = (F.abs(F.col("step")) >= soft) & (F.abs(F.lead("step").over(_series()) + F.col("step")) <= tolerance) & (months_between(F.lead("month").over(_series()), F.col("month")) <= months)
    e = e.withColumn("reversed", F.coalesce(undone, F.lit(False)))
    e = e.withColumn("_undoes", F.coalesce(F.lag("reversed").over(_series()), F.lit(False)))
    e = e.where(((F.abs("step") >= hard) | F.col("reversed")) & ~F.col("_undoes")).drop("_undoes")
    return e.withColumn("type", F.when(F.col("reversed"), "reversal").otherwise("jump"))


def unit_error_candidates(jumps: DataFrame) -> DataFrame:
    """QC14: firm-months in which two or more variables jump; an error if three or more do so by a like power of a thousand."""
    g = jumps.groupBy("stock", "month").agg(F.count_distinct("variable").alias("n"), F.array_join(F.array_sort(F.collect_set("variable")), ",").alias("variables"), F.median(F.abs("step")).alias("size"), (F.max("step") - F.min("step")).alias("spread")).where("n >= 2")
    near = F.least(F.abs(F.col("size") - 3), F.abs(F.col("size") - 6)) <= 0.2
    return g.withColumn("error", (F.col("n") >= 3) & (F.col("spread") <= 0.15) & near)


def error_counts(candidates: DataFrame, p: DataFrame) -> DataFrame:
    """QC15: for each variable its unit errors (the firm-months of `unit_error_candidates` that are errors and name it), and how many
    that is for a thousand of its firms. `p` holds the firm-months in the universe."""
    hits = candidates.where("error").select(F.explode(F.split("variables", ",")).alias("variable")).groupBy("variable").agg(F.count("*").alias("errors"))
    firms = p.groupBy("variable").agg(F.count_distinct("stock").alias("firms"))
    return firms.join(hits, "variable", "left").fillna(0, ["errors"]).withColumn("per_thousand", 1000 * F.col("errors") / F.greatest("firms", F.lit(1)))


def yearly_quantiles(p: DataFrame, qs=(0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) -> DataFrame:
    """QC16: quantiles of each year's firm-years, and their number."""
    return firm_years(p).groupBy("variable", "year").agg(F.count("*").alias("n"), *[F.percentile("value", F.lit(q)).alias(f"p{round(100 * q)}") for q in qs])


def yearly_overview(p: DataFrame, coverage: DataFrame | None = None, trim: float = 0.01) -> DataFrame:
    """QC7: firms, firm-months, months a firm; mean, median and trimmed mean of the firm-years; with `coverage` (QC5) the year's
    mean coverage by number and by cap."""
    fy = firm_years(p)
    cut = fy.groupBy("variable", "year").agg(F.percentile("value", F.array(F.lit(trim), F.lit(1 - trim))).alias("_q"))
    inside = F.when(F.col("value").between(F.col("_q")[0], F.col("_q")[1]), F.col("value"))
    level = fy.join(cut, ["variable", "year"]).groupBy("variable", "year").agg(F.avg("value").alias("mean"), F.median("value").alias("median"), F.avg(inside).alias("trimmed"))
    rows = p.groupBy("variable", F.year("month").alias("year")).agg(F.count_distinct("stock").alias("firms"), F.count("*").alias("n"))
    out = rows.withColumn("months_per_firm", F.col("n") / F.col("firms")).join(level, ["variable", "year"])
    if coverage is None:
        return out
    return out.join(yearly_coverage(coverage), ["variable", "year"], "left")


def yearly_coverage(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("variable", F.year("month").alias("year")).agg(F.avg("ew").alias("ew"), F.avg("vw").alias("vw"))


def robust_extremes(p: DataFrame, limit: float = 5.0) -> DataFrame:
    """QC17: shares of zero and negative values, and values whose robust distance on a log scale is beyond the limit."""
    x = p.withColumn("_x", F.when(F.col("value") > 0, F.log10("value")))
    mid = x.groupBy("variable").agg(F.median("_x").alias("_m"))
    x = x.join(F.broadcast(mid), "variable")
    mad = x.groupBy("variable").agg(F.median(F.abs(F.col("_x") - F.col("_m"))).alias("_s"))
    x = x.join(F.broadcast(mad), "variable").withColumn("z", F.when(F.col("_s") > 1e-9, (F.col("_x") - F.col("_m")) / (1.4826 * F.col("_s"))))
    return x.groupBy("variable").agg(F.count("*").alias("n"), F.avg((F.col("value") == 0).cast("int")).alias("zero"), F.avg((F.col("value") < 0).cast("int")).alias("negative"), F.count_if(F.abs("z") > limit).alias("extreme"))


def yearly_distances(p: DataFrame, nonneg: list[str]) -> DataFrame:
    """QC17: firm-years with `z`, their distance from the year's median in scaled median deviations: of log10 for variables that
    cannot be negative, else of asinh on the year's median size. Null in (near) constant years."""
    fy = firm_years(p)
    scale = fy.groupBy("variable", "year").agg(F.median(F.abs("value")).alias("_s"))
    x = F.when(F.col("variable").isin(nonneg), F.when(F.col("value") > 0, F.log10("value"))).otherwise(F.asinh(F.col("value") / F.nullif(F.col("_s"), F.lit(0.0))))
    fy = fy.join(scale, ["variable", "year"]).withColumn("_x", x)
    fy = fy.join(fy.groupBy("variable", "year").agg(F.median("_x").alias("_m")), ["variable", "year"])
    mad = fy.groupBy("variable", "year").agg((F.median(F.abs(F.col("_x") - F.col("_m"))) * 1.4826).alias("_d"))
    z = F.when(F.col("_d") > 1e-9 * (1 + F.abs("_m")), (F.col("_x") - F.col("_m")) / F.col("_d"))
    return fy.join(mad, ["variable", "year"]).withColumn("z", z).select("variable", "stock", "year", "value", "z")


def implausible_shares(distances: DataFrame, nonneg: list[str], limit: float = 8.0) -> DataFrame:
    """QC17: shares of firm-years that are zero, negative, against the variable's sign, or beyond the limit."""
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    below = F.col("value") < 0
    return distances.groupBy("variable").agg(F.count("*").alias("firm_years"), share(F.col("value") == 0).alias("zero"), share(below).alias("negative"), share(below & F.col("variable").isin(nonneg)).alias("sign_violations"), share(F.abs("z") > limit).alias("extreme"))


def largest_distances(distances: DataFrame, n: int = 25) -> DataFrame:
    """QC17: the n firm-years of each variable that lie farthest out."""
    w = by("variable", order=[F.desc(F.abs("z")), "stock", "year"])
    return distances.where("z is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _growth(p: DataFrame, name: str, gaps: tuple[int, int]) -> DataFrame:
    """Updates (first values and changes) of one variable's positive values, with the log growth to the update a year before."""
    w = by("stock", order="month")
    fresh = F.lag("value").over(w).isNull() | (F.lag("value").over(w) != F.col("value"))
    u = p.withColumn("_f", fresh).where("_f and value > 0").select("stock", "month", "value")
    gap = months_between(F.col("month"), F.lag("month").over(w))
    return u.withColumn(name, F.when(gap.between(*gaps), F.log(F.col("value") / F.lag("value").over(w))))


def fiscal_alignment(e: DataFrame, s: DataFrame, years: list[int], offsets: tuple = (-1, 0, 1), gaps: tuple[int, int] = (10, 14), least: int = 30) -> DataFrame:
    """EC15: growth of one variable at its annual updates against that of another at the update in effect (offset 0), before or
    after it: (offset, year, n, spearman, median). Year 0 holds all; a single year under `least` pairs has no correlation.
    `e` and `s` are (stock, month, value) of known values; growth of 3 or more in size does not count."""
    x = _growth(e, "de", gaps).where("de is not null").select("stock", "month", "de")
    y = _growth(s, "ds", gaps).withColumn("k", F.row_number().over(by("stock", order="month")))
    j = as_of(x, y.select("stock", "month", "k"), "stock", "month", "month", ["k"]).where("matched is not null")
    j = j.select("stock", "month", "de", F.col("matched")["k"].alias("_k"), F.explode(F.array(*map(F.lit, offsets))).alias("offset")).withColumn("k", F.col("_k") + F.col("offset"))
    d = j.join(y.select("stock", "k", "ds"), ["stock", "k"]).where("abs(de) < 3 and abs(ds) < 3")
    d = d.withColumn("year", F.explode(F.array(F.lit(0), F.year("month")))).where(F.col("year").isin(0, *years))
    d = spread_rank(spread_rank(d, "de", "_a", "offset", "year"), "ds", "_b", "offset", "year")
    out = d.groupBy("offset", "year").agg(F.count("*").alias("n"), correlation("_a", "_b").alias("_r"), F.median("de").alias("median"))
    return out.select("offset", "year", "n", F.when((F.col("year") == 0) | (F.col("n") >= least), F.col("_r")).alias("spearman"), "median")


def field_coverage(months: DataFrame, statics: DataFrame, fields: list[str]) -> DataFrame:
    """DG2: how far classification fields cover groups of stock-months: (group, field, n_stocks, share_stocks, share_months,
    vw_share), the last by cap in the last December. `months` has (stock, month, market_cap, groups), groups as an array."""
    last = months.where(F.month("month") == 12).agg(F.max("month").alias("_last"))
    m = months.join(F.broadcast(last), F.col("month") == F.col("_last"), "left").select("stock", F.explode("groups").alias("group"), F.when(F.col("_last").isNotNull(), F.col("market_cap")).alias("_cap"))
    one = m.groupBy("group", "stock").agg(F.count("*").alias("_n"), F.sum("_cap").alias("_cap")).join(statics.select("stock", *fields), "stock", "left")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().alias("has")) for c in fields]))
    x = one.select("group", "_n", "_cap", cells.alias("_f")).select("group", "_n", "_cap", "_f.*")
    has = F.col("has").cast("int")
    return x.groupBy("group", "field").agg(F.count("*").alias("n_stocks"), F.avg(has).alias("share_stocks"), (F.sum(has * F.col("_n")) / F.sum("_n")).alias("share_months"), F.try_divide(F.sum(has * F.coalesce("_cap", F.lit(0.0))), F.sum("_cap")).alias("vw_share"))


def category_counts(months: DataFrame, statics: DataFrame, field: str) -> DataFrame:
    """DG2: distinct stocks of each group in each category of a field, those without one under (missing)."""
    s = months.select("stock", F.explode("groups").alias("group")).distinct().join(statics.select("stock", field), "stock", "left")
    return s.groupBy("group", F.coalesce(field, F.lit("(missing)")).alias("category")).agg(F.count("*").alias("stocks"))


def update_alignment(p: DataFrame, least: int = 50) -> DataFrame:
    """QC20: pairs of variables: share of firm-years, with one change each, in which both change in the same month."""
    c = change_events(p).groupBy("variable", "stock", F.year("month").alias("year")).agg(F.count("*").alias("k"), F.max("month").alias("month")).where("k = 1").drop("k")
    other = c.select(F.col("variable").alias("other"), "stock", "year", F.col("month").alias("other_month"))
    j = c.join(other, ["stock", "year"]).where("variable < other")
    return j.groupBy("variable", "other").agg(F.count("*").alias("n"), F.avg((F.col("month") == F.col("other_month")).cast("int")).alias("same")).where(F.col("n") >= least)


def change_alignment(p: DataFrame, least: int = 50) -> DataFrame:
    """EC12: share of a's changes that fall on a change of b, where b has data."""
    e = change_events(p).select("variable", "stock", "month")
    has = p.select(F.col("variable").alias("other"), "stock", "month")
    hit = e.select(F.col("variable").alias("other"), "stock", "month", F.lit(1).alias("_hit"))
    j = e.join(has, ["stock", "month"]).where("variable <> other").join(hit, ["other", "stock", "month"], "left")
    return j.groupBy("variable", "other").agg(F.count("*").alias("n"), F.avg(F.col("_hit").isNotNull().cast("int")).alias("share")).where(F.col("n") >= least)


def flags(summary: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """QC22: names of the rules that a summary row breaks; unknown values break none."""
    hits = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return summary.withColumn("flags", F.array_join(hits, "; ")).withColumn("n_flags", F.size(hits))


# The battery's limits, by field, whether the field must be at least (1) or at most (-1) so large, and the flag's name.
LIMITS = (
    ("vw_coverage_ref", 1, 0.80, "VW coverage (ref. year)"), ("share_after_last_price", -1, 0.02, "values after last price"), ("share_dead_firms_padded", -1, 0.10, "padding after delisting"), ("share_stale_while_trading", -1, 0.05, "stale while trading"),
    ("share_sign_violations", -1, 0.001, "sign violations"), ("share_extreme", -1, 0.005, "extreme values"), ("unit_errors_per_1000_firms", -1, 1.0, "unit errors"), ("outside_universe_share", -1, 0.50, "outside universe"),
)


def battery_flags(summary: DataFrame) -> DataFrame:
    """QC22 with the battery's own limits, as far as the summary has their fields."""
    return flags(summary, {name: (F.col(c) < limit if side > 0 else F.col(c) > limit) for c, side, limit, name in LIMITS if c in summary.columns})


def battery(p: DataFrame, uni: DataFrame, fye_month: DataFrame, nonneg: list[str], coverage_year: int | None = None, run: int = 24, limit: float = 8.0) -> DataFrame:
    """QC21: one summary row for each variable, all variables in one job, with flags.

    uni has (stock, month, market_cap, delisting_date), fye_month (stock, fye_month); variables in `nonneg` cannot be negative,
    and only these are searched for jumps. Coverage, history, matching and padding use all rows; timing, levels and jumps the rows
    in the universe. The panel meets the universe once and is written in buckets of (variable, stock): every table by these is
    made where its rows lie, and what moves after that are sums by month, year or variable. Coverage is stated for
    `coverage_year` (the year before the last full year unless given) and the last full year."""
    f = bucketed(with_universe(p, uni), ["variable", "stock"], ["month"])
    pu = f.where("in_universe")
    spans = f.groupBy("variable").agg(F.min("month").alias("first_date"), F.max("month").alias("last_date"), F.count("*").alias("_rows"))
    past = history_shares(f).select("variable", F.col("firms").alias("n_firms"), F.col("median_months").alias("median_history_months"), F.col("share_with_gaps").alias("share_firms_with_gaps"), "share_gap_months")
    firms = pu.groupBy("variable").agg(F.count_distinct("stock").alias("n_firms_in_universe"))
    match = matching(f, uni).select("variable", F.col("share_covered").alias("share_universe_firms_ever_covered"), F.col("share_in_universe").alias("share_variable_firms_in_universe"))
    monthly = monthly_coverage(f, uni)
    outside = monthly.groupBy("variable").agg(F.sum("n_outside").alias("_outside"))
    end = uni.agg(F.max("month").alias("_end")).select(F.when(F.month("_end") == 12, F.year("_end")).otherwise(F.year("_end") - 1).alias("_last"))
    end = end.withColumn("_ref", F.lit(coverage_year) if coverage_year is not None else F.col("_last") - 1)
    at = lambda c, year: F.max(F.when(F.col("year") == F.col(year), F.col(c)))
    covered = yearly_coverage(monthly).join(F.broadcast(end)).groupBy("variable").agg(  # one row is broadcast
        F.min(F.when(F.col("vw") >= 0.5, F.col("year"))).alias("first_year_vw_cov_50"), F.first("_ref").alias("coverage_ref_year"), at("ew", "_ref").alias("ew_coverage_ref"), at("vw", "_ref").alias("vw_coverage_ref"),
        at("ew", "_last").alias("ew_coverage_last_year"), at("vw", "_last").alias("vw_coverage_last_year"),
    )
    updates = update_frequency(pu).groupBy("variable").agg(F.median("median").alias("median_changes_per_year"), F.avg("none").alias("share_firm_years_no_change"))
    lag = reporting_lag(pu, fye_month).groupBy("variable").agg(F.min(F.struct((-F.col("share")).alias("less"), "lag")).alias("_l"))
    lag = lag.select("variable", F.col("_l.lag").alias("modal_lag_months"), (-F.col("_l.less")).alias("share_at_modal_lag"))
    stale = staleness(f, uni, run).toDF("variable", "_matched", "share_dead_firms_padded", "share_after_last_price", "share_after_delisting", "share_before_first_price", "share_stale", "share_stale_while_trading", "share_zero_runs_while_trading", "share_firms_with_stale_run").drop("_matched")
    odd = implausible_shares(yearly_distances(pu, nonneg), nonneg, limit).drop("firm_years").toDF("variable", "share_zero", "share_negative", "share_sign_violations", "share_extreme")
    jumps = unit_jumps(pu.where(F.col("variable").isin(nonneg)))
    large = jumps.groupBy("variable").agg(F.count("*").alias("n_large_jumps"))
    errors = error_counts(unit_error_candidates(jumps), pu).select("variable", F.col("errors").alias("n_unit_errors"), F.col("per_thousand").alias("unit_errors_per_1000_firms"))
    out = spans
    for part in (past, firms, match, outside, covered, updates, lag, stale, odd, large, errors):
        out = out.join(part, "variable", "left")
    out = out.fillna(0, ["n_firms_in_universe", "n_large_jumps", "n_unit_errors"]).fillna(0.0, ["unit_errors_per_1000_firms"])
    return battery_flags(out.withColumn("outside_universe_share", F.col("_outside") / F.col("_rows")).drop("_outside", "_rows"))


def change_months(p: DataFrame) -> DataFrame:
    """EC6: share of changes in each month of the year, zero where there is none."""
    e = change_events(p).withColumn("m", F.month("month")).groupBy("variable").pivot("m", list(range(1, 13)))
    w = e.agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(f"`{k}`") for k in range(2, 13)), F.col("`1`"))
    return w.select("variable", *[(F.col(f"`{k}`") / total).alias(f"m{k}") for k in range(1, 13)])


def first_rows_and_changes(p: DataFrame) -> DataFrame:
    """EC9: new values by year: first observations and changes."""
    prev = F.lag("value").over(_series())
    return p.withColumn("_new", prev.isNull() | (prev != F.col("value"))).where("_new").groupBy("variable", F.year("month").alias("year")).agg(F.count("*").alias("n"))
