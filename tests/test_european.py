"""The European order against its screens one by one, and what it leaves on disk."""

import glob
import os
import time

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import tables
from ledgerline.functions.frames import by
from ledgerline.operators import filters as fl

LIMITS = {"least": 3, "one_sign": 0.7, "keep": 2, "history": 30, "zero": 0.3, "run": 2, "high": 0.2, "low": 1e-4, "up": 0.25, "down": -0.15, "active": 0.5, "gap": 0.06, "penny": 0.3}
PERIOD = {"after": "2000-01-05", "until": "2000-06-30"}
FILL = ["open", "high", "low", "close", "return_index", "return_index_eur", "adj_factor", "unadj_close", "unadj_close_eur"]


@pytest.fixture(scope="module")
def rows(spark):
    """36 stocks in four countries (one too small), with whatever each screen looks for, some without statics."""
    rng, all_rows = np.random.default_rng(5), []
    days = pd.bdate_range("2000-01-03", periods=140).date
    for stock in range(36):
        country, n = "ABCD"[min(stock // 11, 3)] + "-LAND", 20 if stock % 9 == 4 else 140
        country = "D-LAND" if stock > 33 else country if country != "D-LAND" else "C-LAND"
        ret = np.where(rng.random(n) < 0.1, 0.0, rng.normal(0.0, 0.03, n))
        ret[rng.integers(2, n, 2)] = 0.0
        if stock % 12 == 5:
            ret = np.abs(ret)  # of one sign
        if stock % 12 == 7:
            ret[rng.random(n) < 0.4] = 0.0
        if stock % 12 == 8:
            ret[7::9] = 0.9  # not undone at once: volatile
        if stock % 12 == 9:
            ret[60], ret[61] = 0.4, -0.3  # undone by the next row
        if stock % 12 == 3:
            ret[-12:] = 0.0  # padded
        if stock % 12 == 10:
            ret[50:55] = 0.0  # stale
        index = 100 * np.cumprod(1 + ret)
        close = np.round(10 * np.exp(rng.normal(0, 0.5)) * index / 100, 6)
        for i in range(n):
            if rng.random() < 0.1:
                continue
            holiday = i % 17 == 6 and stock % 11 < 9
            adj, flat = 1.0 if rng.random() > 0.05 else 1.1, stock % 6 == 1 and i % 10 in (4, 5)
            all_rows.append((
                stock, days[i], country, None if holiday or stock == 14 or rng.random() < 0.02 else float(index[i]), float(index[i]) * (1 + days[i].month / 100), float(close[i]), 99.0 if flat else float(close[i]) * (1.1 if rng.random() > 0.04 else 0.9),
                0.1 if flat else float(close[i]) * 0.9, float(close[i]), 7.0 if flat else float(rng.integers(1, 1000)), adj, None if rng.random() < 0.05 else float(close[i]) * (-1 if rng.random() < 0.02 else 1), float(close[i]) * 0.9,
            ))
    fields = "stock long, date date, country string, return_index double, return_index_eur double, open double, high double, low double, close double, volume double, adj_factor double, unadj_close double, unadj_close_eur double"
    gone = [(s, days[[139, 120, 70][s % 3]] if s % 4 == 3 else None) for s in range(36) if s != 17]
    return spark.createDataFrame(all_rows, fields), spark.createDataFrame(gone, "stock long, delisting_date date")


def one_by_one(panel, delistings, *, after, until, least, one_sign, keep, history, zero, run, high, low, up, down, active, gap, penny, delisting=-0.35):
    """Each screen by its own operator, on a checkpoint of what the one before left; rows left by step."""
    w, left = by("stock", order="date"), []

    def step(p):
        p = p.localCheckpoint()
        left.append(p.count())
        return p

    euro = F.when(F.col("return_index_eur") >= 1e-6, F.col("return_index_eur"))
    p = fl.returns_from_index(panel).withColumn("return_index_eur", euro).withColumn("ret_eur", F.col("return_index_eur") / F.lag("return_index_eur").over(w) - 1)
    p = step(fl.without_index(step(p)))
    p = step(fl.country_minimum(p, least))
    p = step(fl.implausible_returns(p, one_sign))
    p = step(fl.padded_tail(p, delistings, keep)).drop("delisting_date")
    p = step(fl.short_history(p, history, "country"))
    p = step(fl.zero_returns(p, zero))
    p = step(fl.stale_prices(p, "return_index", run))
    p = step(fl.low_volatility(step(fl.high_volatility(p, high)), low))
    p = step(fl.outlier_pairs(p, up, down))
    p = step(fl.holidays(p, active, "country"))
    p = step(fl.adjustment_gaps(p, gap))
    p = step(fl.no_trading(step(fl.implausible_prices(step(fl.nonsense_prices(p))))))
    p = step(fl.handle_missing(p, FILL, ["return_index", "return_index_eur", "unadj_close"]))
    p = fl.delisting_return(p, delistings, delisting)
    p = step(p if delisting is None else fl.scale_flagged(p, "return_index_eur", delisting))
    p = step(fl.penny_stocks(p, penny, "unadj_close_eur", "country"))
    return step(fl.period(p, after, until)), left


@pytest.mark.parametrize("other", [{}, {"delisting": None, "active": 0.005}, {"least": 12, "history": 10, "run": 1, "penny": 0.0}])
def test_order_equals_its_screens(spark, rows, other):
    want, left = one_by_one(*rows, **(LIMITS | PERIOD | other))
    got = fl.european_order(*rows, **(LIMITS | PERIOD | other))
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda d: sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in d.select(sorted(d.columns)).collect())
    assert plain(got) == plain(want) and left[-1] > 0
    if not other:
        # Each screen takes rows, but for those that the panel gives nothing to: low volatility and missing prices after delisting.
        assert sum(a > b for a, b in zip(left, left[1:])) >= 14


def test_columns_for_the_rows_that_are_left(spark, rows):
    panel, gone = rows
    raw = panel.withColumnRenamed("close", "_raw").drop("unadj_close_eur")
    later = {"close": F.col("_raw") * 1, "unadj_close_eur": F.col("_raw") * 0.9}
    a = fl.european_order(panel, gone, **LIMITS, **PERIOD)
    b = fl.european_order(raw, gone, **LIMITS, **PERIOD, later=later).select(a.columns)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_order_leaves_little_on_disk(spark, rows):
    """No table of all rows with their prices, and no shuffle files once the order's own jobs have ended."""
    panel, gone = rows
    shared, env = tables.shared_folder(spark).removeprefix("file://"), spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def shuffled():
        return {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    before, files = set(os.listdir(shared)), shuffled()
    fl.european_order(panel.repartition(4, "stock"), gone, **(LIMITS | PERIOD | {"active": 0.97}))  # most days go
    for _ in range(50):
        if not (left := shuffled() - files):
            break
        time.sleep(0.2)
    assert not left
    for name in set(os.listdir(shared)) - before:
        parts = [pq.read_metadata(f) for f in glob.glob(f"{shared}/{name}/*.parquet")]
        columns = {parts[0].schema.column(i).name for i in range(len(parts[0].schema))}
        assert not columns & {"close", "high", "volume"} or sum(m.num_rows for m in parts) < panel.count() / 2
