"""Screens of the daily panel in a fixed order, as one cascade that keeps for each row the first step that it fails.

Nothing is dropped on the way: a row that fails gets the number of the step in `gone`, and every later statistic is taken over the
rows still without one. So the panel and its report come from one pass. All verdicts within a stock are windows over one
partitioning and one order (stock, date); what looks beyond a stock is a table of one row, or one for each day or month. Before each
of these the rows are written, so that no part of the order is run a second time for it, and those that have failed are set aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import month_number
from ledgerline.functions.frames import by
from ledgerline.functions.tables import bucketed, written
from ledgerline.operators import listings as li

STATIC_STEPS = ("(1) non-common", "(2) cross-listings", "(3) duplicate codes", "(4) foreign firms", "(5) foreign currency")
US_STEPS = (
    "(0) duplicate days", "(11) without return index", *STATIC_STEPS, "(7) implausible returns", "(13) padded values before delisting", "(12) short history", "(8) zero returns", "(14) stale prices", "(9) high volatility",
    "(10) low volatility", "(15) outlier errors", "(16) holidays", "(18) adjustment inconsistencies", "(19) nonsense values", "(own) implausible prices", "(own) no trading activity", "(own) leading missings",
    "(own) delisting adjustment", "(21) penny stocks", "output period",
)


def _stock():
    """One order for all windows, so that rows are sorted once for each part of the order and frames share their pass: months follow dates."""
    return by("stock", order=["_month", "date"])


def _own():
    return _stock().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _past(to: int = -1):
    return _stock().rowsBetween(Window.unboundedPreceding, to)


def alive() -> Column:
    return F.col("gone").isNull()


def among(value: Column) -> Column:
    """The value in rows that are still there."""
    return F.when(alive(), value)


def before(value: Column) -> Column:
    """The value in the stock's last row before this one that is still there, null values included."""
    return F.last(among(F.struct(value.alias("v"))), ignorenulls=True).over(_past())["v"]


class Cascade:
    """Rows with `gone`, and the names of the steps so far; each step marks the rows for which `bad` is true."""

    def __init__(self, rows: DataFrame, names: tuple[str, ...]):
        self.rows, self.names, self.at = rows.withColumn("gone", F.lit(None).cast("int")), names, 0
        self.aside: list[DataFrame] = []

    def let(self, **columns: Column) -> Cascade:
        self.rows = self.rows.withColumns(columns)
        return self

    def fail(self, *bad: Column) -> Cascade:
        """The next steps at once, all on the rows as they are: verdicts on whole stocks, or on single rows without their neighbours."""
        first = F.coalesce(*[F.when(b, F.lit(self.at + k)) for k, b in enumerate(bad, 1)])
        self.at += len(bad)
        self.rows = self.rows.withColumn("gone", F.coalesce("gone", first))
        return self

    def go_on(self, table: DataFrame) -> Cascade:
        """The order goes on with the rows of a written table that are still there; no later step looks at the others."""
        self.aside.append(table.where(~alive()))
        self.rows = table.where(alive())
        return self


def first_static_failure(statics: DataFrame, patterns: DataFrame, venues: DataFrame, currencies: DataFrame, codes: tuple[str, ...] = ("loc", "isin")) -> DataFrame:
    """(stock, static): the first of STATIC_STEPS that each line fails, each screen on all lines of the table; null if none."""
    passed = [li.common_stocks(statics, patterns), li.without_cross_listings(statics, venues), li.without_duplicate_codes(statics, *codes), statics, li.domestic_currency(statics, currencies)]
    held = statics.select("stock", F.lit(-1).alias("step"))
    for k, d in enumerate(passed):
        held = held.unionByName(d.select("stock", F.lit(k).alias("step")))
    every = held.groupBy("stock").agg(F.collect_set("step").alias("ok"))
    failed = F.array_min(F.array_except(F.array(*[F.lit(k) for k in range(len(passed))]), "ok"))
    return every.select("stock", failed.cast("int").alias("static"))


def static_cascade(statics: DataFrame, patterns: DataFrame, venues: DataFrame, currencies: DataFrame, codes: tuple[str, ...] = ("loc", "isin")) -> DataFrame:
    """FX1: the lines with `gone`, the first of the screens 1, 2, 3 and 5 that each fails (1 to 4), each on what the one before left."""
    one = li.common_stocks(statics, patterns)
    two = li.without_cross_listings(one, venues)
    three = li.without_duplicate_codes(two, *codes)
    passed = [one, two, three, li.domestic_currency(three, currencies)]
    last = passed[0].select("stock", F.lit(2).alias("gone"))
    for k, d in enumerate(passed[1:], 3):
        last = last.unionByName(d.select("stock", F.lit(k).alias("gone")))
    last = last.groupBy("stock").agg(F.max("gone").alias("gone"))
    return statics.join(last, "stock", "left").withColumn("gone", F.when(F.col("gone").isNull(), 1).when(F.col("gone") <= len(passed), F.col("gone")))


def us_order(
    panel: DataFrame, statics: DataFrame, verdicts: DataFrame, *, after: str, until: str, one_sign: float = 0.98, keep: int = 9, history: int = 120, zero: float = 0.95, run: int = 30, high: float = 0.4, low: float = 1e-6,
    up: float = 1.0, down: float = -0.5, active: float = 0.005, gap: float = 0.05, delisting: float | None = -0.35, penny: float = 0.25,
    fill: tuple[str, ...] = ("open", "high", "low", "close", "return_index", "adj_factor", "unadj_close"),
    require: tuple[str, ...] = ("open", "high", "low", "close", "volume", "return_index", "adj_factor", "unadj_close"),
) -> DataFrame:
    """FO9: the whole order of a panel of one country, every row with `gone` (a number in US_STEPS from 1; null: stays).

    statics: (stock, delisting_date) of the country's lines; verdicts: `first_static_failure` of them. Stocks without
    statics fail the first static screen. Columns `ret`, `filled` and `delisted` are added; where a row stays, gaps of `fill` are filled
    from the stock's rows before, and its last row takes the delisting return. The order up to the penny screen is run in three parts when
    this is called, each on what the one before left, and written to the shared folder."""
    rows = panel.join(statics.select("stock", "delisting_date", F.lit(True).alias("_known")).join(verdicts, "stock"), "stock", "left")
    c = Cascade(rows.withColumn("_month", month_number(F.col("date"))), US_STEPS)
    c.fail(F.col("date").eqNullSafe(F.lag(F.col("date")).over(by("stock", order=["_month", "date", "return_index"]))) & (F.row_number().over(by("stock", order=["_month", "date", "return_index"])) > 1))
    index = F.when(F.col("return_index") >= 1e-6, F.col("return_index"))
    c.let(return_index=index).let(ret=F.try_divide("return_index", before(F.col("return_index"))) - 1)
    late = F.coalesce(F.col("date") > F.col("delisting_date"), F.lit(False))
    c.let(
        _known_index=F.count(among(F.col("return_index"))).over(_own()),
        _rising=F.avg(among(F.when(F.col("ret") != 0, (F.col("ret") > 0).cast("double")))).over(_own()),
        _moved=F.max(among(F.when(~late & (F.coalesce("ret", F.lit(0.0)) != 0), F.col("date")))).over(_own()),
    )
    static = [(F.col("static") == k) | (F.col("_known").isNull() if k == 0 else F.lit(False)) for k in range(len(STATIC_STEPS))]
    c.fail(F.col("_known_index") == 0, *static, (F.col("_rising") > one_sign) | (1 - F.col("_rising") > one_sign))
    c.let(_tail=~late & (F.col("_moved").isNull() | (F.col("date") > F.col("_moved"))))
    c.let(_padded=F.count(among(F.when(F.col("_tail"), 1))).over(_past(0)))
    c.fail(F.col("delisting_date").isNotNull() & (late | (F.col("_tail") & (F.col("_padded") > keep))))

    # Each part is written in buckets by stock: what follows reads it twice, and its windows need no further exchange.
    c.go_on(bucketed(c.rows.drop("static", "_known", "_known_index", "_rising", "_moved", "_tail", "_padded"), ["stock"], ["date"]))
    end = c.rows.agg(F.max(among(F.col("date"))).alias("_end"))  # one row
    c.rows = c.rows.join(F.broadcast(end))
    c.let(_n=F.count(among(F.lit(1))).over(_own()), _begin=F.min(among(F.col("date"))).over(_own()), _idle=F.avg(among(F.coalesce(F.col("ret") == 0, F.lit(False)).cast("double"))).over(_own()))
    c.fail((F.col("_n") < history) & (F.date_diff("_end", "_begin") >= history), F.col("_idle") > zero)

    c.let(_same=before(F.col("return_index")), _number=F.count(among(F.lit(1))).over(_past(0)))
    fresh = F.col("return_index").isNull() | ~F.coalesce(F.col("return_index") == F.col("_same"), F.lit(False))
    c.let(_start=F.last(among(F.when(fresh, F.col("_number"))), ignorenulls=True).over(_past(0)))
    c.fail(F.col("_number") - F.col("_start") >= run)
    c.let(_spread=F.stddev_samp(among(F.col("ret"))).over(_own()), _was=before(F.col("ret")))
    c.fail(F.col("_spread") > high, F.col("_spread") < low)

    c.let(_undone=F.coalesce(((F.col("_was") > up) & (F.col("ret") < down)) | ((F.col("_was") < down) & (F.col("ret") > up)), F.lit(False)))
    c.let(_alive=among(F.col("_undone"))).let(_next=F.expr("lead(_alive) ignore nulls over (partition by stock order by _month, date)"))
    c.fail(F.col("_undone") | F.col("_next"))
    c.let(_first=F.coalesce(alive() & (F.min(among(F.col("date"))).over(_own()) == F.col("date")), F.lit(False)))

    c.go_on(bucketed(c.rows.drop("_end", "_n", "_begin", "_idle", "_same", "_number", "_start", "_spread", "_was", "_undone", "_alive", "_next"), ["stock"], ["date"]))

    # Days of the calendar: bounded, whatever the number of stocks. Each stock counts on its first day, so the sum is their number.
    days = c.rows.groupBy("date").agg(F.count_if(F.col("ret") != 0).alias("_n"), F.count_if("_first").alias("_new"))
    days = days.withColumn("_all", F.sum("_new").over(Window.partitionBy(F.lit(1)))).where(F.col("_n") >= active * F.col("_all"))
    c.rows = c.rows.join(F.broadcast(days.select("date", F.lit(True).alias("_open"))), "date", "left")
    want = F.col("unadj_close") * F.col("adj_factor")
    gaps = F.when(want == 0, F.col("close") != 0).otherwise(F.abs(F.col("close") - want) / F.abs(F.when(want != 0, want)) > gap)
    odd = F.coalesce(F.col("high") < F.greatest("open", "close", "low"), F.lit(False)) | F.coalesce(F.col("low") > F.least("open", "close", "high"), F.lit(False))
    c.fail(F.col("_open").isNull(), gaps, F.col("unadj_close") <= 0, odd)
    c.let(_traded=before(F.struct("high", "low", "volume")))
    c.fail((F.col("high") == F.col("_traded.high")) & (F.col("low") == F.col("_traded.low")) & (F.col("volume") == F.col("_traded.volume")))

    finite = {x: F.when(~F.abs(x).isin(float("inf")), F.col(x)) for x in dict.fromkeys([*fill, *require, "ret"])}
    ready = F.min(among(F.when(F.expr(" and ".join(f"{x} is not null" for x in require)), F.col("date")))).over(_own())
    c.let(**finite).let(_ready=ready).fail(F.col("_ready").isNull() | (F.col("date") < F.col("_ready")))
    lacks = F.expr(" or ".join(f"{x} is null" for x in fill))
    c.let(filled=lacks)
    gone = late if delisting is not None else F.lit(False)
    c.let(_last=F.max(among(F.when(~gone, F.col("date")))).over(_own()), **{x: among(F.last(among(F.col(x)), ignorenulls=True).over(_past(0))) for x in fill})

    c.fail(gone)
    c.let(delisted=F.lit(delisting is not None) & alive() & F.col("delisting_date").isNotNull() & (F.col("date") == F.col("_last")))
    if delisting is not None:
        c.let(ret=F.when(F.col("delisted"), (1 + F.coalesce("ret", F.lit(0.0))) * (1 + delisting) - 1).otherwise(F.col("ret")), return_index=F.when(F.col("delisted"), F.col("return_index") * (1 + delisting)).otherwise(F.col("return_index")))

    # The last known price of the stock's previous month with a row, null if it has none; its quantile over the month's rows.
    months = by("stock", order="_month").rangeBetween(Window.unboundedPreceding, -1)
    priced = F.struct("_month", F.col("unadj_close").isNotNull().alias("known"), "date", F.col("unadj_close").alias("v"))
    c.let(_price=F.max(among(priced)).over(months)["v"])
    c.rows = written(c.rows.drop("_first", "_open", "_traded", "_ready", "_last"))
    cut = c.rows.where(alive()).groupBy("_month").agg(F.percentile("_price", F.lit(penny)).alias("_cut"))
    c.rows = c.rows.join(F.broadcast(cut), "_month", "left")  # months of the calendar
    c.fail(F.col("_price") < F.col("_cut"))
    c.fail((F.col("date") <= F.lit(after).cast("date")) | (F.col("date") > F.lit(until).cast("date")))
    out = c.rows
    for d in c.aside:
        d = d.withColumns(finite).withColumn("filled", lacks).withColumns({x: among(F.col(x)) for x in fill})
        out = out.unionByName(d.withColumn("delisted", F.lit(False)), allowMissingColumns=True)
    return out.drop(*[x for x in out.columns if x.startswith("_")])


def survivors(marked: DataFrame) -> DataFrame:
    return marked.where(alive()).drop("gone")


def filter_report(marked: DataFrame, names: tuple[str, ...], key: str = "country") -> DataFrame:
    """FX2: (step, name, key, stocks, rows) left after each step, step 0 before all; for each value of the key and in total.

    One aggregate of the marked rows by stock: a stock is left as long as its last row is. The steps are a table of fixed size."""
    done = len(names) + 1
    by_stock = marked.groupBy(key, "stock", F.coalesce("gone", F.lit(done)).alias("gone")).agg(F.count("*").alias("rows"))
    by_stock = by_stock.withColumn("last", F.max("gone").over(by("stock")))
    cells = by_stock.groupBy(key, "gone").agg(F.sum("rows").alias("rows"), F.count_if(F.col("gone") == F.col("last")).alias("stocks"))
    steps = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(n).alias("name")) for k, n in enumerate(("all rows", *names))]), lambda s: s.step < F.col("gone")))
    left = cells.select("*", steps.alias("s")).groupBy(F.col("s.step").alias("step"), F.col("s.name").alias("name"), key).agg(F.sum("stocks").alias("stocks"), F.sum("rows").alias("rows"))
    total = left.groupBy("step", "name").agg(F.sum("stocks").alias("stocks"), F.sum("rows").alias("rows")).withColumn(key, F.lit("TOTAL"))
    return left.unionByName(total)
