"""Regressions by group, long-run standard errors, sorts, factors and event studies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerline.functions.dates import months_between
from ledgerline.functions.frames import by, correlation, full_frame, quantile_bin


def winsorize(df: DataFrame, columns: list[str], q: float, key: str = "month") -> DataFrame:
    """AP1: each column cut to its quantiles q and 1 - q within the key."""
    cut = df.groupBy(key).agg(*[F.percentile(c, F.array(F.lit(q), F.lit(1 - q))).alias(f"_{c}") for c in columns])
    out = df.join(cut, key).withColumns({c: F.when(F.col(c).isNotNull(), F.least(F.greatest(c, F.col(f"_{c}")[0]), F.col(f"_{c}")[1])) for c in columns})
    return out.drop(*[f"_{c}" for c in columns])


def grouped_ols2(df: DataFrame, y: str, x1: str, x2: str, key: str, least: int = 100) -> DataFrame:
    """STAT1: least squares of y on a constant and two regressors in each group, from sums of products; no group is collected."""
    d = df.where(f"{y} is not null and {x1} is not null and {x2} is not null")
    c = lambda a, b: F.covar_samp(a, b)
    g = d.groupBy(key).agg(F.count("*").alias("n"), F.avg(y).alias("_y"), F.avg(x1).alias("_a"), F.avg(x2).alias("_b"), c(x1, x1).alias("_aa"), c(x2, x2).alias("_bb"), c(x1, x2).alias("_ab"), c(x1, y).alias("_ay"), c(x2, y).alias("_by"), c(y, y).alias("_yy"))
    g = g.where(F.col("n") >= least).withColumn("_d", F.col("_aa") * F.col("_bb") - F.col("_ab") * F.col("_ab"))
    g = g.withColumns({"b1": F.try_divide(F.col("_ay") * F.col("_bb") - F.col("_by") * F.col("_ab"), "_d"), "b2": F.try_divide(F.col("_by") * F.col("_aa") - F.col("_ay") * F.col("_ab"), "_d")})
    return g.withColumns({"b0": F.col("_y") - F.col("b1") * F.col("_a") - F.col("b2") * F.col("_b"), "r2": F.try_divide(F.col("b1") * F.col("_ay") + F.col("b2") * F.col("_by"), "_yy")}).select(key, "n", "b0", "b1", "b2", "r2")


def hac_mean(df: DataFrame, series: str, order: str, value: str, lags: int) -> DataFrame:
    """STAT2: mean, its Newey-West standard error (Bartlett weights) and t of each series; lags count known rows."""
    d = df.where(F.col(value).isNotNull()).withColumn("_u", F.col(value) - F.avg(value).over(by(series)))
    w = by(series, order=order)
    terms = [F.sum(F.col("_u") * F.col("_u"))] + [2 * (1 - k / (lags + 1)) * F.coalesce(F.sum(f"_u{k}"), F.lit(0.0)) for k in range(1, lags + 1)]
    d = d.withColumns({f"_u{k}": F.col("_u") * F.lag("_u", k).over(w) for k in range(1, lags + 1)})
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    out = d.groupBy(series).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), (F.sqrt(F.greatest(total, F.lit(0.0))) / F.count("*")).alias("se"))
    return out.withColumn("t", F.try_divide("mean", "se"))


def standardize(df: DataFrame, columns: list[str], key: str = "month") -> DataFrame:
    """AP2: each column less its mean over its standard deviation within the key; null where it does not vary."""
    s = df.groupBy(key).agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(f"_{c}") for c in columns])
    out = df.join(s, key).withColumns({c: F.try_divide(F.col(c) - F.col(f"_{c}")["m"], F.col(f"_{c}")["s"]) for c in columns})
    return out.drop(*[f"_{c}" for c in columns])


def _solve(df: DataFrame, size: int, matrix, right, name) -> DataFrame:
    """Columns name(0), name(1), ... with the solution of each row's symmetric equations, by elimination on columns.

    `matrix(i, j)` and `right(i)` give the columns of the system. A pivot that falls under 1e-10 of its first value means
    that the regressors are collinear: all of the row's solution is null."""
    a = lambda i, j: f"_s{i}_{j}"
    df = df.withColumns({a(i, j): right(i) if j == size else matrix(i, j) for i in range(size) for j in range(i, size + 1)})
    df = df.withColumns({f"_d{i}": F.col(a(i, i)) for i in range(size)})
    for p in range(size):
        df = df.withColumn(a(p, p), F.when(F.col(a(p, p)) > 1e-10 * F.col(f"_d{p}"), F.col(a(p, p))))
        later = [(i, j) for i in range(p + 1, size) for j in range(i, size + 1)]
        df = df.withColumns({a(i, j): F.col(a(i, j)) - F.col(a(p, i)) * F.col(a(p, j)) / F.col(a(p, p)) for i, j in later})
    for i in reversed(range(size)):
        known = sum((F.col(a(i, j)) * F.col(name(j)) for j in range(i + 1, size)), F.lit(0.0))
        df = df.withColumn(name(i), (F.col(a(i, size)) - known) / F.col(a(i, i)))
    return df.drop(*[a(i, j) for i in range(size) for j in range(i, size + 1)], *[f"_d{i}" for i in range(size)])


def grouped_ols(df: DataFrame, y: str, xs: list[str], key: str, least: int = 100) -> DataFrame:
    """STAT1: least squares of y on a constant and any number of regressors in each group: (key, n, const, one column for
    each regressor, r2). Rows with a missing value do not count; groups of under `least` rows go; collinear ones are null.

    Only covariances leave the map side, so no group is collected; the equations are solved on columns of one row."""
    names, k = [*xs, y], len(xs)
    d = df.where(" and ".join(f"{c} is not null" for c in names))
    cov = {f"_c{i}_{j}": F.covar_samp(names[i], names[j]) for i in range(k + 1) for j in range(i, k + 1)}
    g = d.groupBy(key).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(names)], *[c.alias(n) for n, c in cov.items()]).where(F.col("n") >= least)
    g = _solve(g, k, lambda i, j: F.col(f"_c{i}_{j}"), lambda i: F.col(f"_c{i}_{k}"), lambda i: f"_b{i}")
    const = sum((-F.col(f"_b{i}") * F.col(f"_m{i}") for i in range(k)), F.col(f"_m{k}"))
    r2 = F.try_divide(sum((F.col(f"_b{i}") * F.col(f"_c{i}_{k}") for i in range(1, k)), F.col("_b0") * F.col(f"_c0_{k}")), f"_c{k}_{k}")
    return g.select(key, "n", const.alias("const"), *[F.col(f"_b{i}").alias(x) for i, x in enumerate(xs)], r2.alias("r2"))


def fama_macbeth(df: DataFrame, xs: list[str], y: str = "ret_next", least: int = 100, winsor: float = 0.01, scale: bool = True, lags: int = 6, start: str | None = None, end: str | None = None) -> tuple[DataFrame, DataFrame]:
    """AP2: regressions of each month on winsorized and standardized regressors, and the mean of every coefficient with its
    Newey-West t: (summary by series, coefficients by month). Rows with a missing value go first; the dates are inclusive."""
    d = df.where(" and ".join(f"{c} is not null" for c in [*xs, y])).select("month", y, *xs)
    if start is not None:
        d = d.where(F.col("month") >= F.lit(start).cast("date"))
    if end is not None:
        d = d.where(F.col("month") <= F.lit(end).cast("date"))
    d = winsorize(d, xs, winsor) if winsor else d
    d = standardize(d, xs) if scale else d
    coefs = grouped_ols(d, y, xs, "month", least)
    return hac_mean(coefs.unpivot("month", ["const", *xs], "series", "v"), "series", "month", "v", lags), coefs


def hac_ols(df: DataFrame, y: str, xs: list[str], series: str, order: str, lags: int) -> DataFrame:
    """PF8: least squares of each series on several factors with Newey-West errors: (series, variable, n, coef, se, t).

    The error of a coefficient is the long-run sum of residual times the part of its regressor that the others do not
    explain, over that part's sum of squares; this equals the sandwich formula. Bartlett weights, no small-sample factor."""
    names, k = ["const", *xs], len(xs) + 1
    d = df.where(" and ".join(f"{c} is not null" for c in [y, *xs])).select(series, order, y, *xs).withColumn("const", F.lit(1.0))
    every = [*names, y]
    g = d.groupBy(series).agg(F.count("*").alias("n"), *[F.sum(F.col(every[i]) * F.col(every[j])).alias(f"_c{i}_{j}") for i in range(k) for j in range(i, k + 1)])
    c = lambda i, j: F.col(f"_c{min(i, j)}_{max(i, j)}")
    g = _solve(g, k, c, lambda i: c(i, k), lambda i: f"_b{i}")
    for v in range(k):
        rest = [i for i in range(k) if i != v]
        g = _solve(g, k - 1, lambda i, j, rest=rest: c(rest[i], rest[j]), lambda i, rest=rest, v=v: c(rest[i], v), lambda i, rest=rest, v=v: f"_g{v}_{rest[i]}")
    d = d.join(g.drop(*[f"_c{i}_{j}" for i in range(k) for j in range(i, k + 1)]), series)
    residual = sum((-F.col(f"_b{i}") * F.col(names[i]) for i in range(k)), F.col(y))
    own = [sum((-F.col(f"_g{v}_{i}") * F.col(names[i]) for i in range(k) if i != v), F.col(names[v])) for v in range(k)]
    d = d.withColumns({"_e": residual, **{f"_x{v}": own[v] for v in range(k)}})
    cells = F.explode(F.array(*[F.struct(F.lit(names[v]).alias("variable"), F.col(f"_b{v}").alias("coef"), (F.col("_e") * F.col(f"_x{v}")).alias("_u"), (F.col(f"_x{v}") * F.col(f"_x{v}")).alias("_q")) for v in range(k)]))
    d = d.select(series, order, "n", cells.alias("_z")).select(series, order, "n", "_z.*")
    w = by(series, "variable", order=order)
    d = d.withColumns({f"_u{j}": F.col("_u") * F.lag("_u", j).over(w) for j in range(1, lags + 1)})
    total = F.sum(F.col("_u") * F.col("_u"))
    for j in range(1, lags + 1):
        total = total + 2 * (1 - j / (lags + 1)) * F.coalesce(F.sum(f"_u{j}"), F.lit(0.0))
    out = d.groupBy(series, "variable").agg(F.first("n").alias("n"), F.first("coef").alias("coef"), F.try_divide(F.sqrt(F.greatest(total, F.lit(0.0))), F.sum("_q")).alias("se"))
    return out.withColumn("t", F.try_divide("coef", "se"))


def sorts(df: DataFrame, char: str, ret: str, weight: str, bins: int = 10, least: int = 20, key: str = "month") -> DataFrame:
    """AP3: equally- and cap-weighted mean return of each bin of a characteristic."""
    d = df.where(f"{char} is not null and {ret} is not null and {weight} > 0").withColumn("bin", quantile_bin([char, "stock"], bins, key)).withColumn("_n", F.count("*").over(by(key))).where(F.col("_n") >= least)
    return d.groupBy(key, "bin").agg(F.count("*").alias("n"), F.avg(ret).alias("ew"), (F.sum(F.col(ret) * F.col(weight)) / F.sum(weight)).alias("vw"))


def spread(binned: DataFrame, bins: int, value: str = "ew", key: str = "month") -> DataFrame:
    """AP3: the highest less the lowest bin."""
    top, low = (F.max(F.when(F.col("bin") == k, F.col(value))) for k in (bins, 1))
    return binned.groupBy(key).agg((top - low).alias("spread"))


def june_sorts(df: DataFrame, reference: Column, char: str, least: int = 50) -> DataFrame:
    """AP4: size halves and 30/70 groups of a characteristic at each formation, by breakpoints of the reference stocks."""
    cut = df.where(reference & F.col(char).isNotNull()).groupBy("formation").agg(F.count("*").alias("_n"), F.percentile("market_cap", F.lit(0.5)).alias("_m"), F.percentile(char, F.array(F.lit(0.3), F.lit(0.7))).alias("_q")).where(F.col("_n") >= least)
    d = df.join(F.broadcast(cut), "formation").where(F.col(char).isNotNull() & F.col("market_cap").isNotNull())
    group = F.when(F.col(char) <= F.col("_q")[0], "L").when(F.col(char) <= F.col("_q")[1], "M").otherwise("H")
    return d.withColumn("cell", F.concat(F.when(F.col("market_cap") <= F.col("_m"), "S").otherwise("B"), group)).drop("_n", "_m", "_q")


def two_by_three(cells: DataFrame) -> DataFrame:
    """AP5: size and characteristic factors from the six cells' returns of a month; a missing cell leaves null."""
    p = cells.groupBy("month").pivot("cell", ["SL", "SM", "SH", "BL", "BM", "BH"]).agg(F.sum(F.col("ret") * F.col("cap_lag")) / F.sum("cap_lag"))
    return p.select("month", ((F.col("SL") + F.col("SM") + F.col("SH")) / 3 - (F.col("BL") + F.col("BM") + F.col("BH")) / 3).alias("smb"), ((F.col("SH") + F.col("BH")) / 2 - (F.col("SL") + F.col("BL")) / 2).alias("hml"))


def june_characteristics(d: DataFrame) -> DataFrame:
    """AP5: (stock, formation, market_cap, bm, op, inv) of each June: book equity on the cap of the December before,
    profitability and asset growth, from rows with `characteristics`."""
    december = d.where("month(month) = 12").select("stock", F.last_day(F.add_months("month", 6)).alias("month"), F.col("market_cap").alias("_dec"))
    june = d.where("month(month) = 6 and market_cap > 0").join(december, ["stock", "month"], "left")
    bm = F.when(F.col("equity") > 0, F.col("equity")) / F.when(F.col("_dec") > 0, F.col("_dec"))
    return june.select("stock", F.year("month").alias("formation"), "market_cap", bm.alias("bm"), "op", F.col("ag").alias("inv"))


def june_groups(df: DataFrame, reference: Column, chars: list[str], least: int = 50) -> DataFrame:
    """AP5: (stock, formation, char, size, group) by breakpoints of the reference stocks: size S or B at their median, each
    characteristic low, mid or high at their 30 and 70 % quantiles. Formations with fewer reference stocks go; a stock has a
    row for each characteristic that it has."""
    d = df.where("market_cap > 0").withColumn("_ref", reference).select("stock", "formation", "market_cap", "_ref", *chars)
    size = d.where("_ref").groupBy("formation").agg(F.count("*").alias("_n"), F.percentile("market_cap", F.lit(0.5)).alias("_m")).where(F.col("_n") >= least)
    long = d.unpivot(["stock", "formation", "market_cap", "_ref"], chars, "char", "value").where("value is not null")
    cut = long.where("_ref").groupBy("formation", "char").agg(F.percentile("value", F.array(F.lit(0.3), F.lit(0.7))).alias("_q"))
    j = long.join(size, "formation").join(cut, ["formation", "char"], "left")
    group = F.when(F.col("value") <= F.col("_q")[0], "low").when(F.col("value") > F.col("_q")[1], "high").otherwise("mid")
    return j.select("stock", "formation", "char", F.when(F.col("market_cap") <= F.col("_m"), "S").otherwise("B").alias("size"), group.alias("group"))


def factors(monthly: DataFrame, groups: DataFrame, signs: dict[str, tuple[str, int]]) -> DataFrame:
    """AP5: factors of each month from the value-weighted cells of all sorts; `signs` maps a characteristic to its factor's
    name and to 1 (high less low) or -1. Each characteristic has its size factor too, and `smb` is their mean. Returns run
    from July of the formation's year to next June; a missing cell leaves null."""
    m = monthly.where("ret is not null and cap_lag > 0").withColumn("formation", F.year("month") - (F.month("month") <= 6).cast("int"))
    cells = m.join(groups, ["stock", "formation"]).groupBy("month", "char", "size", "group").agg((F.sum(F.col("ret") * F.col("cap_lag")) / F.sum("cap_lag")).alias("v"))
    at = lambda c, s, g: F.max(F.when((F.col("char") == c) & (F.col("size") == s) & (F.col("group") == g), F.col("v")))
    out = {}
    for char, (name, sign) in signs.items():
        out[name] = sign * ((at(char, "S", "high") + at(char, "B", "high")) / 2 - (at(char, "S", "low") + at(char, "B", "low")) / 2)
        out[f"smb_{char}"] = (at(char, "S", "low") + at(char, "S", "mid") + at(char, "S", "high")) / 3 - (at(char, "B", "low") + at(char, "B", "mid") + at(char, "B", "high")) / 3
    f = cells.groupBy("month").agg(*[v.alias(k) for k, v in out.items()])
    return f.withColumn("smb", sum((F.col(f"smb_{c}") for c in list(signs)[1:]), F.col(f"smb_{next(iter(signs))}")) / len(signs))


def earnings_events(snaps: DataFrame, value: str, base: str, event: str = "fye", gap: tuple[int, int] = (9, 15)) -> DataFrame:
    """AP8: (stock, event_month, year, signal) of annual reports: change of a value over the previous report's base, where all three are known,
    the base is positive and the previous report so many months before."""
    months = months_between(F.col("report_month"), F.col("prev_report_month"))
    s = snaps.where(F.col(value).isNotNull() & F.col(f"{value}_prev").isNotNull() & (F.col(f"{base}_prev") > 0) & months.between(*gap))
    signal = (F.col(value) - F.col(f"{value}_prev")) / F.col(f"{base}_prev")
    return s.select("stock", F.col(event).alias("event_month"), F.year(event).alias("year"), signal.alias("signal"))


def event_returns(events: DataFrame, monthly: DataFrame, k_min: int, k_max: int, groups: int) -> DataFrame:
    """AP8: (stock, event_month, group, k, ret_adj): market-adjusted returns in the months around events, whose signal falls in groups by
    year (years of under 5 events a group have none)."""
    e = events.where("signal is not null").withColumn("_n", F.count("*").over(by("year"))).where(F.col("_n") >= 5 * groups)
    e = e.withColumn("group", quantile_bin(["signal", "stock"], groups, "year")).withColumn("k", F.explode(F.sequence(F.lit(k_min), F.lit(k_max))))
    e = e.withColumn("month", F.last_day(F.add_months("event_month", F.col("k"))))
    return e.join(monthly.where("ret is not null").select("stock", "month", (F.col("ret") - F.avg("ret").over(by("month"))).alias("ret_adj")), ["stock", "month"])


def event_study(events: DataFrame, monthly: DataFrame, k_min: int, k_max: int, groups: int) -> DataFrame:
    """AP8: mean market-adjusted return of each signal group in the months around an event, and its running sum."""
    g = event_returns(events, monthly, k_min, k_max, groups).groupBy("group", "k").agg(F.count("*").alias("n"), F.avg("ret_adj").alias("mean"))
    return g.withColumn("cumulative", F.sum("mean").over(by("group", order="k")))


def cohort_spread(events: DataFrame, monthly: DataFrame, k_min: int, k_max: int, groups: int) -> DataFrame:
    """AP8: for each month around the event the mean over cohorts (events of one month) of the highest group's mean less the lowest's,
    its t over cohorts, and the cohorts that have both."""
    end = lambda k: F.avg(F.when(F.col("group") == k, F.col("ret_adj")))
    c = event_returns(events, monthly, k_min, k_max, groups).groupBy("k", "event_month").agg((end(groups) - end(1)).alias("s")).where("s is not null")
    out = c.groupBy("k").agg(F.avg("s").alias("spread"), (F.avg("s") / F.nullif(F.stddev_samp("s") / F.sqrt(F.count("*")), F.lit(0.0))).alias("t"), F.count("*").alias("cohorts"))
    return out


def compare_to_market(df: DataFrame, key: str, order: str, per_year: int, lags: int) -> DataFrame:
    """PF7, PF10: each key's portfolio (port) beside the market (mkt_rf over the riskless rf): correlation, alpha and beta of the excess
    return with Newey-West t, fit, means, volatilities and tracking error a year. Rows with a missing value do not count."""
    d = df.where("port is not null and mkt_rf is not null and rf is not null").select(key, order, "port", "mkt_rf", "rf")
    d = d.withColumns({"_x": F.col("port") - F.col("rf"), "_m": F.col("mkt_rf") + F.col("rf")}).withColumn("_d", F.col("port") - F.col("_m"))
    fit = hac_ols(d, "_x", ["mkt_rf"], key, order, lags).groupBy(key).pivot("variable", ["const", "mkt_rf"]).agg(F.first("coef").alias("coef"), F.first("t").alias("t"))
    year, root = F.lit(per_year), F.sqrt(F.lit(per_year))
    s = d.groupBy(key).agg(
        F.count("*").alias("n"), F.min(order).alias("start"), F.max(order).alias("end"), correlation("port", "_m").alias("corr"), F.regr_r2("_x", "mkt_rf").alias("r2"), (F.avg("port") * year).alias("mean_port"), (F.avg("_m") * year).alias("mean_mkt"),
        (F.avg("_d") * year).alias("mean_diff"), (F.stddev_samp("_d") * root).alias("tracking_error"), (F.stddev_samp("port") * root).alias("vol_port"), (F.stddev_samp("_m") * root).alias("vol_mkt"),
    )
    out = s.join(fit, key)
    return out.select(*s.columns, F.col("const_coef").alias("alpha"), (F.col("const_coef") * year).alias("alpha_annual"), F.col("const_t").alias("alpha_t"), F.col("mkt_rf_coef").alias("beta"), F.col("mkt_rf_t").alias("beta_t"))


def compare_factors(df: DataFrame, lags: int = 6, least: int = 24) -> DataFrame:
    """AP6: each factor (factor, month, mine, bench) beside the published one: correlation, means and volatilities a year with Newey-West
    t of the means, slope and fit of the published on the own factor, tracking error a year. Factors of under `least` common
    months go."""
    d = df.where("mine is not null and bench is not null").withColumn("_d", F.col("mine") - F.col("bench"))
    root = F.sqrt(F.lit(12))
    s = d.groupBy("factor").agg(
        F.count("*").alias("n"), F.min("month").alias("start"), F.max("month").alias("end"), correlation("mine", "bench").alias("corr"), (12 * F.avg("mine")).alias("mean_mine"), (12 * F.avg("bench")).alias("mean_bench"), (root * F.stddev_samp("mine")).alias("vol_mine"),
        (root * F.stddev_samp("bench")).alias("vol_bench"), F.regr_slope("bench", "mine").alias("slope"), F.regr_r2("bench", "mine").alias("r2"), (root * F.stddev_samp("_d")).alias("tracking_error"),
    ).where(F.col("n") >= least)
    for c in ("mine", "bench"):
        s = s.join(hac_mean(d, "factor", "month", c, lags).select("factor", F.col("t").alias(f"t_{c}")), "factor")
    return s


def characteristics(d: DataFrame) -> DataFrame:
    """DER5: next return, lagged and log cap, momentum of months 2 to 12, last return and book-to-market; where the columns are
    there, also profitability (operating income less interest, a missing one as 0, on positive equity), asset growth on the
    previous report and earnings yield."""
    w = by("stock", order="month")
    gap = lambda f: F.round(F.months_between(f("month", 1).over(w), F.col("month")))
    log_ret = F.log1p("ret")
    book = F.when(F.col("equity") > 0, F.col("equity"))
    more = {}
    if "operating_income" in d.columns:
        cost = F.coalesce("interest", F.lit(0.0)) if "interest" in d.columns else F.lit(0.0)
        more["op"] = (F.col("operating_income") - cost) / book
    if {"assets", "assets_prev"} <= set(d.columns):
        more["ag"] = F.col("assets") / F.when(F.col("assets_prev") > 0, F.col("assets_prev")) - 1
    if "net_income" in d.columns:
        more["ep"] = F.try_divide("net_income", "market_cap")
    return d.withColumns(
        {
            "ret_next": F.when(gap(F.lead) == 1, F.lead("ret").over(w)),
            "me_lag": F.when(gap(F.lag) == -1, F.lag("market_cap").over(w)),
            "log_me": F.when(F.col("market_cap") > 0, F.log("market_cap")),
            "str_1": F.col("ret"),
            "mom_12_2": F.expm1(full_frame(log_ret, F.sum, w, 11, -1)),
            "log_bm": F.when((F.col("equity") > 0) & (F.col("market_cap") > 0), F.log(F.col("equity") / F.col("market_cap"))),
        }
        | more
    )


def edge_spread(panel: DataFrame, window: int = 21) -> DataFrame:
    """ADJ4: bid-ask spread from open, high, low and close over so many rows (the published EDGE estimator), signed and cut to [0, 0.25].

    Every frame mean is a plain average over rows, taken for a batch of rows at once: a frame of the engine adds up its rows again for each
    row and mean. Null with under two rows that moved; a price that is no number counts as missing.
    """
    w = by("stock", order="date")
    logs = {f"_{c}": F.when(F.col(x) > 0, F.log(x)) for c, x in zip("ohlc", ("open", "high", "low", "close"), strict=True)}
    p = panel.withColumns(logs).withColumn("_m", (F.col("_h") + F.col("_l")) / 2)
    p = p.withColumns({f"_{c}1": F.lag(f"_{c}").over(w) for c in "hlcm"})
    c = F.col
    moved = ((c("_h") != c("_l")) | (c("_l") != c("_c1"))).cast("double")
    p = p.withColumns({"_r1": c("_m") - c("_o"), "_r2": c("_o") - c("_m1"), "_r3": c("_m") - c("_c1"), "_r4": c("_c1") - c("_m1"), "_r5": c("_o") - c("_c1"), "_t": moved})
    prob = lambda a, b: c("_t") * (c(a) != c(b)).cast("double")
    p = p.withColumns({"_p1": prob("_o", "_h"), "_p2": prob("_o", "_l"), "_p3": prob("_c1", "_h1"), "_p4": prob("_c1", "_l1")})
    # Each stock is whole in its partition (of the lags) and in order, so the frames run on through the batches with the rows before. A frame
    # that reaches back over a stock's first row holds its null r4, and gives null.
    names = ["_r1", "_r2", "_r3", "_r4", "_r5", "_t", "_p1", "_p2", "_p3", "_p4"]
    size = window - 1
    kept = panel.columns

    def spreads(batches):
        held = np.full((len(names), size - 1), np.nan)
        for batch in batches:
            own = np.stack([batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False).astype(float) for x in names])
            held = np.concatenate([held, own], 1)
            spread = _edge(dict(zip(names, held, strict=True)), size)
            held = held[:, held.shape[1] - (size - 1) :]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(x)) for x in kept], pa.array(spread, pa.float64(), mask=np.isnan(spread))], [*kept, "spread"])

    p = p.select(*kept, *names).sortWithinPartitions("stock", "date")
    return p.mapInArrow(spreads, StructType([*panel.schema.fields, StructField("spread", DoubleType())]))


def _edge(x: dict[str, np.ndarray], size: int) -> np.ndarray:
    """The spread of each full frame of `size` rows, NaN for none; x has the terms of `edge_spread`, NaN for null."""
    r1, r2, r3, r4, r5, t = (x[k] for k in ("_r1", "_r2", "_r3", "_r4", "_r5", "_t"))

    def total(v):
        out = np.zeros(len(v) - size + 1)
        for k in range(size):
            out += v[k : k + len(out)]
        return out

    def mean(v):
        missing = np.isnan(v)
        n = total((~missing).astype(float))
        return np.where(n > 0, total(np.where(missing, 0.0, v)) / np.maximum(n, 1), np.nan)

    def moments(terms):
        """Frame means of x and x**2 from row-level products: x is a sum of four terms (constant, product)."""
        one, two = 0.0, 0.0
        for i, (k, v) in enumerate(terms):
            one = one + k * mean(v)
            for j in range(i, len(terms)):  # each product of two different terms stands twice in the square
                two = two + (1 if i == j else 2) * k * terms[j][0] * mean(v * terms[j][1])
        return one, two

    # x1 = a d1 r2 + b d3 r4 and x2 = a d1 r5 + b d5 r4, with d_i = r_i - t * g_i; g, a and b are constants of the frame.
    with np.errstate(divide="ignore", invalid="ignore"):
        moved, full = total(np.where(np.isnan(t), 0.0, t)), total((~np.isnan(r4)).astype(float)) == size
        po, pc = mean(x["_p1"]) + mean(x["_p2"]), mean(x["_p3"]) + mean(x["_p4"])
        a, b, mt = -4 / po, -4 / pc, mean(t)
        g1, g3, g5 = (mean(r) / mt for r in (r1, r3, r5))
        e1, s1 = moments([(a, r1 * r2), (-a * g1, t * r2), (b, r3 * r4), (-b * g3, t * r4)])
        e2, s2 = moments([(a, r1 * r5), (-a * g1, t * r5), (b, r5 * r4), (-b * g5, t * r4)])
        v1, v2 = s1 - e1 * e1, s2 - e2 * e2
        square = np.where(v1 + v2 > 0, (v2 * e1 + v1 * e2) / (v1 + v2), (e1 + e2) / 2)
        signed = np.sign(square) * np.sqrt(np.abs(square))
    ok = full & (moved >= 2) & (po != 0) & (pc != 0) & ~np.isnan(po) & ~np.isnan(pc)
    return np.where(ok, np.clip(np.nan_to_num(signed, nan=0.0), 0.0, 0.25), np.nan)
