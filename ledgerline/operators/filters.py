"""Screens of the daily panel: by stock, by row and by date, and the delisting adjustment.

A panel has (stock, date) rows. Verdicts on stocks are one aggregate and a semi or anti join; verdicts on rows are windows over
one partitioning by stock; verdicts on dates are one small frame that is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import month_number
from ledgerline.functions.frames import by, first_rows, island
from ledgerline.functions.tables import written


def _stock():
    return by("stock", order="date")


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _without_stocks(panel: DataFrame, bad: DataFrame) -> DataFrame:
    return panel.join(bad.select("stock"), "stock", "left_anti")


def first_wins(panel: DataFrame, *tie: str) -> DataFrame:
    """One row for each stock and day."""
    return first_rows(panel, ["stock", "date"], list(tie) or ["return_index"])


def returns_from_index(panel: DataFrame) -> DataFrame:
    """Return to the stock's previous row; an index under 1e-6 counts as missing."""
    ri = F.when(F.col("return_index") >= 1e-6, F.col("return_index"))
    return panel.withColumn("return_index", ri).withColumn("ret", F.try_divide("return_index", F.lag("return_index").over(_stock())) - 1)


def implausible_returns(panel: DataFrame, share: float = 0.98) -> DataFrame:
    """drop stocks whose returns, other than zero, are nearly all of one sign."""
    signs = panel.where("ret <> 0").groupBy("stock").agg(F.avg((F.col("ret") > 0).cast("double")).alias("up"))
    return _without_stocks(panel, signs.where((F.col("up") > share) | (1 - F.col("up") > share)))


def zero_returns(panel: DataFrame, share: float = 0.95) -> DataFrame:
    """F8: drop stocks with more than this share of zero returns among all rows."""
    return _without_stocks(panel, panel.groupBy("stock").agg(F.avg(_false(F.col("ret") == 0).cast("double")).alias("z")).where(F.col("z") > share))


def high_volatility(panel: DataFrame, limit: float = 0.4) -> DataFrame:
    """drop stocks whose standard deviation of returns is above the limit; unknown stays."""
    return _without_stocks(panel, panel.groupBy("stock").agg(F.stddev_samp("ret").alias("s")).where(F.col("s") > limit))


def low_volatility(panel: DataFrame, limit: float = 1e-6) -> DataFrame:
    """drop stocks whose standard deviation of returns is under the limit; unknown stays."""
    return _without_stocks(panel, panel.groupBy("stock").agg(F.stddev_samp("ret").alias("s")).where(F.col("s") < limit))


def without_index(panel: DataFrame) -> DataFrame:
    """drop stocks that never have a return index."""
    return _without_stocks(panel, panel.groupBy("stock").agg(F.count("return_index").alias("n")).where("n = 0"))


def short_history(panel: DataFrame, rows: int = 120, key: str | None = None) -> DataFrame:
    """keep stocks with so many rows, or whose first row is less than so many days before the panel's last (that of their
    own group, if a key of the stock is given)."""
    if key is not None:
        s = panel.groupBy(key, "stock").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("_end"))
        keep = s.join(s.groupBy(key).agg(F.max("_end").alias("last")), key).where((F.col("n") >= rows) | (F.date_diff("last", "first") < rows))
        return panel.join(keep.select("stock"), "stock", "left_semi")
    s = panel.groupBy("stock").agg(F.count("*").alias("n"), F.min("date").alias("first"))
    last = panel.agg(F.max("date").alias("last"))
    keep = s.join(F.broadcast(last)).where((F.col("n") >= rows) | (F.date_diff("last", "first") < rows))
    return panel.join(keep.select("stock"), "stock", "left_semi")


def padded_tail(panel: DataFrame, delistings: DataFrame, keep: int = 9) -> DataFrame:
    """no rows after delisting; of the zero or missing returns at a delisted stock's end the first `keep` stay. Stocks
    without a delisting date stay whole, those without statics go."""
    p = panel.join(delistings, "stock").where(F.col("delisting_date").isNull() | (F.col("date") <= F.col("delisting_date")))
    p = p.withColumn("_live", F.max(F.when(F.coalesce(F.col("ret"), F.lit(0.0)) != 0, F.col("date"))).over(by("stock")))
    after = F.col("_live").isNull() | (F.col("date") > F.col("_live"))
    p = p.withColumn("_tail", F.sum(after.cast("int")).over(_stock().rowsBetween(Window.unboundedPreceding, 0)))
    return p.where(~after | (F.col("_tail") <= keep) | F.col("delisting_date").isNull()).drop("_live", "_tail")


def stale_prices(panel: DataFrame, column: str = "return_index", run: int = 30) -> DataFrame:
    """drop rows from run + 1 on of equal values in a row; a missing value ends a run."""
    changed = F.col(column).isNull() | ~_false(F.col(column) == F.lag(column).over(_stock()))
    p = panel.withColumn("_run", island(changed, _stock()))
    p = p.withColumn("_at", F.row_number().over(by("stock", "_run", order="date")))
    return p.where(F.col("_at") <= run).drop("_run", "_at")


def _pair(up: float, down: float) -> Column:
    """Whether the next row undoes this row's jump."""
    after = F.lead("ret").over(_stock())
    return _false(((F.col("ret") > up) & (after < down)) | ((F.col("ret") < down) & (after > up)))


def outlier_pairs(panel: DataFrame, up: float = 1.0, down: float = -0.5, method: str = "drop") -> DataFrame:
    """a jump that the next row undoes; both rows go, or their returns become 0."""
    p = panel.withColumn("_pair", _pair(up, down)).withColumn("_bad", F.col("_pair") | _false(F.lag("_pair").over(_stock())))
    if method == "zero":
        return p.withColumn("ret", F.when(F.col("_bad"), F.lit(0.0)).otherwise(F.col("ret"))).drop("_pair", "_bad")
    return p.where(~F.col("_bad")).drop("_pair", "_bad")


def holidays(panel: DataFrame, share: float = 0.005, key: str | None = None) -> DataFrame:
    """F16: keep dates on which so large a share of all stocks (of each group, if a key is given) has a return other than zero."""
    if key is not None:
        stocks = panel.groupBy(key).agg(F.count_distinct("stock").alias("all"))
        days = panel.groupBy(key, "date").agg(F.count_if(F.col("ret") != 0).alias("n")).join(stocks, key).where(F.col("n") >= share * F.col("all"))
        return panel.join(days.select(key, "date"), [key, "date"], "left_semi")
    stocks = panel.agg(F.count_distinct("stock").alias("all"))
    days = panel.groupBy("date").agg(F.count_if(F.col("ret") != 0).alias("n")).join(F.broadcast(stocks)).where(F.col("n") >= share * F.col("all"))
    return panel.join(days.select("date"), "date", "left_semi")


def survivorship(panel: DataFrame, statics: DataFrame, starts: DataFrame) -> DataFrame:
    """rows from the start date of the stock's country on; countries without a start go."""
    own = statics.select("stock", "country").join(starts, "country").select("stock", "start")
    return panel.join(own, "stock").where("date >= start").drop("start")


def adjustment_gaps(panel: DataFrame, limit: float = 0.05) -> DataFrame:
    """keep rows whose price is within the limit of unadjusted price times factor; unknown and 0/0 stay, x/0 goes."""
    want = F.col("unadj_close") * F.col("adj_factor")
    off = F.when(want == 0, F.when(F.col("close") != 0, F.lit(float("inf")))).otherwise(F.abs(F.col("close") - want) / F.when(want != 0, want))
    return panel.where(~_false(off > limit))


def nonsense_prices(panel: DataFrame) -> DataFrame:
    """drop unadjusted prices of zero or less; missing ones stay."""
    return panel.where(~_false(F.col("unadj_close") <= 0))


def penny_stocks(panel: DataFrame, quantile: float, column: str = "unadj_close", *keys: str) -> DataFrame:
    """drop a stock's month if its last price of the previous observed month is under the month's quantile,
    taken over the month's daily rows (of each group, if keys of the stock are given); months without a previous one stay."""
    last = panel.groupBy("stock", *keys, F.last_day("date").alias("_month")).agg(F.max_by(column, F.when(F.col(column).isNotNull(), F.col("date"))).alias("_last"), F.count("*").alias("_n"))
    last = last.withColumn("_prev", F.lag("_last").over(by("stock", order="_month")))
    cut = panel.select("stock", F.last_day("date").alias("_month")).join(last, ["stock", "_month"]).groupBy("_month", *keys).agg(F.percentile("_prev", F.lit(quantile)).alias("_cut"))
    bad = last.join(cut, ["_month", *keys]).where("_prev < _cut").select("stock", "_month")
    return panel.withColumn("_month", F.last_day("date")).join(bad, ["stock", "_month"], "left_anti").drop("_month")


def country_minimum(panel: DataFrame, least: int = 20) -> DataFrame:
    """F6 on a panel: keep countries with so many distinct stocks."""
    big = panel.groupBy("country").agg(F.count_distinct("stock").alias("n")).where(F.col("n") >= least)
    return panel.join(big.select("country"), "country", "left_semi")


def european_order(
    panel: DataFrame, delistings: DataFrame, *, after: str, until: str, least: int = 20, one_sign: float = 0.98, keep: int = 9, history: int = 120, zero: float = 0.95, run: int = 30, high: float = 0.4, low: float = 1e-6,
    up: float = 1.0, down: float = -0.5, active: float = 0.005, gap: float = 0.05, delisting: float | None = -0.35, penny: float = 0.05,
    later: dict[str, Column] | None = None,
) -> DataFrame:
    """FO10: all screens of a panel of many countries in their order. `country`, one for each stock, is a key wherever a screen looks
    beyond one stock (number of stocks, last date, holidays, penny quantile), so no country is a loop. Screens read the local return; the
    euro index runs beside it, takes the same delisting return, and euro prices decide the penny screen.

    The panel is read twice, by its own columns each time, and never written whole: first for the few columns that the numbers of each
    country and its open days come from, then for the rows themselves. Both go through windows over one partitioning by stock, so a panel
    that comes partitioned by stock needs no exchange here. Dates and flags of the first reading and the rows before the penny
    screen are written to the shared folder when this is called. later: columns that only screens after the holidays look at, to be worked
    out from the panel's for the rows that are left then. Columns whose names begin with _ are not returned."""
    rows = _country_free(panel, delistings, one_sign=one_sign, keep=keep, zero=zero, run=run, high=high, low=low, up=up, down=down)
    listed = (F.col("_place") == 1) & F.col("_known")
    marks = written(rows.where("_in or _place = 1").select("country", "date", listed.alias("_listed"), "_in", "_first", (F.col("ret") != 0).alias("_moved"), "_n", "_begin", "_end"))
    countries = marks.groupBy("country").agg(F.count_if("_listed").alias("_stocks"), F.max("_end").alias("_last")).where(F.col("_stocks") >= least)

    def lasting(d: DataFrame) -> DataFrame:
        """F6 and F12 on rows that passed all else so far: both are verdicts on whole stocks."""
        d = d.where("_in").join(F.broadcast(countries.select("country", "_last")), "country")
        return d.where((F.col("_n") >= history) | (F.date_diff("_last", "_begin") < history))

    # Days of the calendar of each country: bounded, whatever the number of stocks. Each stock counts on its first day, so the sum is their number.
    days = marks.transform(lasting).groupBy("country", "date").agg(F.count_if("_moved").alias("_moves"), F.count_if("_first").alias("_new"))
    days = days.select("country", "date", "_moves", F.sum("_new").over(by("country")).alias("_all")).where(F.col("_moves") >= active * F.col("_all"))
    p = rows.transform(lasting).join(F.broadcast(days), ["country", "date"])
    # They ask for the day's count, which each row has, so that no screen on them is moved ahead of the join.
    p = p.withColumns({c: F.when(F.col("_moves") >= 0, v) for c, v in (later or {}).items()})
    p = p.drop(*[c for c in p.columns if c.startswith("_")])
    p = p.transform(adjustment_gaps, gap).transform(nonsense_prices).transform(implausible_prices).transform(no_trading)
    fill = ["open", "high", "low", "close", "return_index", "return_index_eur", "adj_factor", "unadj_close", "unadj_close_eur"]
    p = p.transform(handle_missing, fill, ["return_index", "return_index_eur", "unadj_close"]).transform(_last_takes, delisting)
    p = p if delisting is None else p.transform(scale_flagged, "return_index_eur", delisting)

    # the last known price of the stock's previous month with a row, null if it has none; its quantile over the month's rows.
    price = F.struct("_month", F.col("unadj_close_eur").isNotNull().alias("known"), "date", F.col("unadj_close_eur").alias("v"))
    months = by("stock", order="_month").rangeBetween(Window.unboundedPreceding, -1)
    p = written(p.withColumn("_month", month_number(F.col("date"))).withColumn("_price", F.max(price).over(months)["v"]))
    cut = p.groupBy("country", "_month").agg(F.percentile("_price", F.lit(penny)).alias("_cut"))
    p = p.join(F.broadcast(cut), ["country", "_month"], "left").where(~_false(F.col("_price") < F.col("_cut")))
    return p.drop("_month", "_price", "_cut").transform(period, after, until)


def _country_free(panel: DataFrame, delistings: DataFrame, *, one_sign: float, keep: int, zero: float, run: int, high: float, low: float, up: float, down: float) -> DataFrame:
    """What the first half of the European order says without a look beyond the stock. `_in` marks the rows that are left, `_first` each stock's
    first of these. `_n`, `_begin` and `_end` are number, first and last date of the stock's rows after the padding screen; a stock
    keeps its row with `_place` 1 for them, whatever becomes of it. `_known`: the stock has an index."""
    w = _stock()  # one order for all windows, so that those which need nothing of each other share a pass
    past, own = (w.rowsBetween(Window.unboundedPreceding, end) for end in (0, Window.unboundedFollowing))
    p = panel.join(delistings.select("stock", "delisting_date", F.lit(True).alias("_static")), "stock", "left")
    p = p.withColumns({c: F.when(F.col(c) >= 1e-6, F.col(c)) for c in ("return_index", "return_index_eur")})
    p = p.withColumns({r: F.try_divide(c, F.lag(c).over(w)) - 1 for r, c in (("ret", "return_index"), ("ret_eur", "return_index_eur"))})

    listed = F.col("delisting_date").isNull() | _false(F.col("date") <= F.col("delisting_date"))
    moves = F.coalesce("ret", F.lit(0.0)) != 0
    p = p.withColumns({
        "_known": F.count("return_index").over(own) > 0,
        "_rising": F.avg(F.when(F.col("ret") != 0, (F.col("ret") > 0).cast("double"))).over(own),
        "_live": F.max(F.when(listed & moves, F.col("date"))).over(own),
    })
    padded = F.col("_live").isNull() | (F.col("date") > F.col("_live"))
    p = p.withColumn("_tail", F.sum((listed & padded).cast("int")).over(past))
    one_way = _false((F.col("_rising") > one_sign) | (1 - F.col("_rising") > one_sign))
    p = p.withColumn("_in", F.col("_known") & ~one_way & _false(F.col("_static")) & listed & (~padded | (F.col("_tail") <= keep) | F.col("delisting_date").isNull()))
    mine = lambda c: F.when(F.col("_in"), c)
    p = p.withColumns({
        "_n": F.count(mine(F.lit(1))).over(own), "_begin": F.min(mine(F.col("date"))).over(own), "_end": F.max(mine(F.col("date"))).over(own),
        "_idle": F.avg(mine(_false(F.col("ret") == 0).cast("double"))).over(own), "_place": F.row_number().over(w),
    })
    p = p.where("_in or (_n = 0 and _place = 1)").drop("_static", "_rising", "_live", "_tail")

    # F14 by places in the stock: a run's place is the row's less that of the row it began with.
    index = F.col("return_index")
    p = p.withColumns({"_place": F.row_number().over(w), "_fresh": index.isNull() | ~_false(index == F.lag(index).over(w))})
    p = p.withColumn("_start", F.last(F.when(F.col("_fresh"), F.col("_place")), ignorenulls=True).over(past)).where(F.col("_place") - F.col("_start") < run)
    p = p.withColumns({"_spread": F.stddev_samp("ret").over(own), "_pair": _pair(up, down)})
    p = p.withColumn("_in", F.col("_in") & ~_false(F.col("_idle") > zero) & ~_false((F.col("_spread") > high) | (F.col("_spread") < low)))
    p = p.withColumn("_in", F.col("_in") & ~(F.col("_pair") | _false(F.lag("_pair").over(w))))
    p = p.withColumn("_first", F.col("_in") & (F.sum(F.col("_in").cast("int")).over(past) == 1))
    return p.drop("_idle", "_fresh", "_start", "_spread", "_pair")


def implausible_prices(panel: DataFrame) -> DataFrame:
    """FO1: high is the highest and low the lowest of the day's prices, where known."""
    top, bottom = F.greatest("open", "close", "low"), F.least("open", "close", "high")
    return panel.where(~_false(F.col("high") < top) & ~_false(F.col("low") > bottom))


def extreme_prices(panel: DataFrame, limit: float = 1e6) -> DataFrame:
    """FO2: drop rows with a price above the limit."""
    return panel.where(~_false(F.greatest("open", "high", "low", "close") > limit))


def decimal_errors(panel: DataFrame, up: float = 4.0, down: float = -0.85) -> DataFrame:
    """FO3: keep returns within the limits; missing ones go."""
    return panel.where(F.col("ret").between(down, up))


def no_trading(panel: DataFrame) -> DataFrame:
    """FO4: drop rows with high, low and volume all equal to the row before."""
    return panel.withColumn("_same", _false((F.col("high") == F.lag("high").over(_stock())) & (F.col("low") == F.lag("low").over(_stock())) & (F.col("volume") == F.lag("volume").over(_stock())))).where("not _same").drop("_same")


def extreme_returns(panel: DataFrame, low: float = 0.001, high: float = 0.999) -> DataFrame:
    """FO5: keep returns within a date's quantiles; missing ones go."""
    cut = panel.groupBy("date").agg(F.percentile("ret", F.array(F.lit(low), F.lit(high))).alias("_q"))
    return panel.join(cut, "date").where(F.col("ret").between(F.col("_q")[0], F.col("_q")[1])).drop("_q")


def extreme_returns_by_deviation(panel: DataFrame, times: float = 8.0) -> DataFrame:
    """FO6: drop returns more than so many standard deviations from a date's median; missing ones stay."""
    cut = panel.groupBy("date").agg(F.median("ret").alias("_m"), F.stddev_samp("ret").alias("_s"))
    return panel.join(cut, "date").where(~_false(F.abs(F.col("ret") - F.col("_m")) > times * F.col("_s"))).drop("_m", "_s")


def handle_missing(panel: DataFrame, fill: list[str], require: list[str], flag: str = "filled") -> DataFrame:
    """FO7: history begins with the first row that has all of `require`; later gaps of `fill` take the last value, flagged."""
    ready = F.min(F.when(F.expr(" and ".join(f"{c} is not null" for c in require)), F.col("date"))).over(by("stock"))
    p = panel.withColumn("_ready", ready).where("date >= _ready").drop("_ready")
    past = _stock().rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn(flag, F.expr(" or ".join(f"{c} is null" for c in fill)))
    return p.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in fill})


def null_profile(df: DataFrame) -> DataFrame:
    """FO8: columns with missing values, how many and which share."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot("_n", df.columns, "column", "nulls").where("nulls > 0").select("column", "nulls", (F.col("nulls") / F.col("_n")).alias("share"))


def delisting_return(panel: DataFrame, delistings: DataFrame, d: float | None = -0.35, flag: str = "delisted") -> DataFrame:
    """ADJ1: no rows after delisting, and the last one left takes the delisting return in return and index."""
    p = panel.join(delistings, "stock", "left")
    if d is not None:
        p = p.where(F.col("delisting_date").isNull() | (F.col("date") <= F.col("delisting_date")))
    return _last_takes(p, d, flag)


def _last_takes(p: DataFrame, d: float | None, flag: str = "delisted") -> DataFrame:
    """A delisted stock's last row, flagged, takes the delisting return."""
    if d is None:
        return p.withColumn(flag, F.lit(False))
    last = F.lead(F.lit(True)).over(_stock()).isNull() & F.col("delisting_date").isNotNull()
    p = p.withColumn(flag, last)
    return p.withColumns({"ret": F.when(F.col(flag), (1 + F.coalesce("ret", F.lit(0.0))) * (1 + d) - 1).otherwise(F.col("ret")), "return_index": F.when(F.col(flag), F.col("return_index") * (1 + d)).otherwise(F.col("return_index"))})


def scale_flagged(panel: DataFrame, column: str, d: float, flag: str = "delisted", undo: bool = False) -> DataFrame:
    """ADJ2, ADJ3: apply the delisting return to another index by the flag, or take it off again."""
    factor = 1 / (1 + d) if undo else 1 + d
    return panel.withColumn(column, F.when(F.col(flag), F.col(column) * factor).otherwise(F.col(column)))


def period(panel: DataFrame, after: str, until: str) -> DataFrame:
    """ADJ5: rows after one date, up to and with another."""
    return panel.where((F.col("date") > F.lit(after).cast("date")) & (F.col("date") <= F.lit(until).cast("date")))
