"""Every registered query against its SQL on the smallest tables, and small cases of the operators' edges."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates, frames
from ledgerline.operators import checks, filters, listings, pit, statistics, universe
from ledgerline.plans import QUERIES, SQL
from ledgerline.sources import imports

TABLES = "region nation customer supplier part orders lineitem events"


@pytest.fixture(scope="session")
def duck(data):
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def same_rows(a: pd.DataFrame, b: pd.DataFrame) -> None:
    def plain(x):
        if isinstance(x, (list, np.ndarray)):
            return str(list(x))
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
            return ""
        if isinstance(x, (bool, np.bool_)):
            return str(bool(x))
        if isinstance(x, (int, float, np.number)):
            return f"{float(x):.8g}"
        return str(x)[:10] if hasattr(x, "isoformat") else str(x)

    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda d: sorted(tuple(map(plain, r)) for r in d[sorted(d.columns)].itertuples(index=False))
    assert rows(a) == rows(b)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, data, name):
    same_rows(QUERIES[name](spark, data).toPandas(), duck.execute(SQL[name]).df())


def panel(spark, rets, stock=1, start="2000-01-03", **more):
    days = pd.bdate_range(start, periods=len(rets)).date
    d = pd.DataFrame({"stock": stock, "date": days, "ret": rets} | more)
    d = d.astype(object).where(d.notna(), None)
    kinds = {"stock": "long", "date": "date"}
    return spark.createDataFrame([tuple(r) for r in d.itertuples(index=False)], ", ".join(f"{c} {kinds.get(c, 'double')}" for c in d.columns))


def none_delisted(spark):
    return spark.createDataFrame([(1, None)], "stock long, delisting_date date")


def test_padded_tail_keeps_nine(spark):
    p = panel(spark, [0.1, 0.0, 0.2] + [0.0, None] * 10)
    gone = spark.createDataFrame([(1, pd.Timestamp("2100-01-01").date())], "stock long, delisting_date date")
    assert filters.padded_tail(p, gone).count() == 12
    assert filters.padded_tail(panel(spark, [0.0] * 15), gone).count() == 9
    assert filters.padded_tail(p, none_delisted(spark)).count() == 23  # an active stock stays whole
    assert filters.padded_tail(panel(spark, [0.1, 0.2], stock=5), gone).count() == 0


def test_stale_run_and_missing_values(spark):
    p = panel(spark, [0.0] * 36, return_index=[1.0] * 32 + [None, 1.0, 1.0, 2.0])
    assert filters.stale_prices(p).count() == 34


def test_outlier_pairs(spark):
    p = panel(spark, [0.1, 1.5, -0.6, 0.1, None, 2.0])
    assert [r.ret for r in filters.outlier_pairs(p).orderBy("date").collect()] == [0.1, 0.1, None, 2.0]
    assert [r.ret for r in filters.outlier_pairs(p, method="zero").orderBy("date").collect()] == [0.1, 0.0, 0.0, 0.1, None, 2.0]


def test_shares_of_zero_and_sign(spark):
    assert filters.zero_returns(panel(spark, [0.0] * 97 + [None] * 3)).count() == 0
    assert filters.zero_returns(panel(spark, [0.0] * 95 + [None] * 5)).count() == 100
    assert filters.implausible_returns(panel(spark, [0.1] * 99 + [0.0, None])).count() == 0
    assert filters.implausible_returns(panel(spark, [0.0, None])).count() == 2


def test_adjustment_by_zero(spark):
    p = panel(spark, [0.0] * 5, close=[100.0, 100.0, 0.0, None, 100.0], unadj_close=[100.0, 0.0, 0.0, 1.0, 50.0], adj_factor=[1.02, 1.0, 1.0, 1.0, 1.0])
    assert [r.unadj_close for r in filters.adjustment_gaps(p).orderBy("date").collect()] == [100.0, 0.0, 1.0]


def test_unknown_prices_stay(spark):
    p = panel(spark, [0.0] * 3, open=[1.0, 1.0, None], high=[2.0, 0.5, None], low=[1.0, 0.5, None], close=[1.5, 1.0, None], unadj_close=[None, 0.0, -1.0], volume=[1.0, 1.0, 1.0])
    assert filters.implausible_prices(p).count() == 2
    assert filters.extreme_prices(p, 1.9).count() == 2
    assert filters.nonsense_prices(p).count() == 1


def test_missing_values_fill_forward(spark):
    p = panel(spark, [0.0] * 4, open=[None, 1.0, None, 2.0], close=[None, 3.0, 4.0, None])
    got = filters.handle_missing(p, ["open", "close"], ["open", "close"]).orderBy("date").collect()
    assert [(r.open, r.close, r.filled) for r in got] == [(1.0, 3.0, False), (1.0, 4.0, True), (2.0, 4.0, True)]


def test_delisting_return(spark):
    d = spark.createDataFrame([(1, pd.Timestamp("2000-01-05").date())], "stock long, delisting_date date")
    p = panel(spark, [0.1, 0.1, None, 0.1], return_index=[100.0, 110.0, 120.0, 130.0])
    got = filters.delisting_return(p, d).orderBy("date").collect()
    assert len(got) == 3 and got[-1].ret == pytest.approx(-0.35) and got[-1].return_index == pytest.approx(78.0)
    assert filters.delisting_return(p, d, None).count() == 4


def test_filters_of_nothing(spark):
    p = panel(spark, [0.1]).limit(0)
    for f in (filters.implausible_returns, filters.zero_returns, filters.high_volatility, filters.short_history, filters.outlier_pairs, filters.holidays, filters.extreme_returns):
        assert f(p).count() == 0


def test_two_digit_years(spark):
    got = spark.createDataFrame([("17/04/96",), ("01/01/69",), ("31/12/68",), ("x",), (None,)], "d string").select(dates.two_digit_year(F.col("d")).alias("d")).collect()
    assert [str(r.d) for r in got] == ["1996-04-17", "1969-01-01", "2068-12-31", "None", "None"]


def test_as_of_takes_whole_rows(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (1, 1), (2, 5)], "k long, t long")
    right = spark.createDataFrame([(1, 2, 1.0, 1.0), (1, 10, None, 3.0)], "k long, s long, a double, b double")
    got = {(r.k, r.t): r.matched for r in frames.as_of(left, right, "k", "t", "s", ["a", "b"]).collect()}
    assert got[1, 5].a == 1.0 and (got[1, 10].a, got[1, 10].b) == (None, 3.0) and got[1, 1] is None and got[2, 5] is None


@pytest.mark.parametrize("n", [20, 37, 200])
def test_quantile_bins_equal_cut_ranks(spark, n):
    got = spark.range(n).select("id", F.lit(1).alias("g")).select("id", frames.quantile_bin(["id"], 10, "g").alias("b")).orderBy("id").toPandas().b
    want = pd.qcut(pd.Series(range(n)).rank(method="first"), 10, labels=False) + 1
    assert list(got) == list(want)


def test_expired_snapshot_blocks_older_ones(spark):
    day = lambda s: pd.Timestamp(s).date()
    snaps = spark.createDataFrame([(1, day("2000-01-31"), day("2000-12-31"), 5.0, day("2001-04-30")), (1, day("1998-01-31"), day("1998-12-31"), 3.0, day("1999-04-30"))], "stock long, report_month date, fye date, x double, available date")
    uni = spark.createDataFrame([(1, day(d)) for d in ("1999-03-31", "1999-04-30", "2001-03-31", "2001-04-30", "2002-06-30", "2002-07-31")], "stock long, month date")
    got = [r.x for r in pit.attach(uni, snaps, ["x"]).orderBy("month").collect()]
    assert got == [None, 3.0, None, 5.0, 5.0, None]


def test_snapshots_on_gaps_and_nulls(spark):
    day = lambda s: pd.Timestamp(s).date()
    rows = [("2000-01-31", 1.0), ("2000-02-29", 1.0), ("2000-03-31", None), ("2000-04-30", None), ("2000-07-31", None), ("2000-08-31", 2.0)]
    w = spark.createDataFrame([(1, day(d), v) for d, v in rows], "stock long, month date, x double")
    assert [str(r.report_month) for r in pit.report_snapshots(w, ["x"]).orderBy("report_month").collect()] == ["2000-01-31", "2000-03-31", "2000-07-31", "2000-08-31"]


def test_unit_jump_is_counted_once(spark):
    months = [x.date() for x in pd.date_range("2000-01-31", periods=6, freq="ME")]
    p = spark.createDataFrame([("v", 1, m, v) for m, v in zip(months, [5.0, 5.0, 5000.0, 5000.0, 5.1, 5.1], strict=True)], "variable string, stock long, month date, value double")
    got = checks.unit_jumps(p).collect()
    assert len(got) == 1 and got[0].month == months[2] and (got[0].reversed, got[0].type) == (True, "reversal")
    through_zero = spark.createDataFrame([("v", 1, m, v) for m, v in zip(months, [5.0, 0.0, 5000.0], strict=False)], "variable string, stock long, month date, value double")
    assert checks.unit_jumps(through_zero).count() == 0
    flat = checks.prepare(p.withColumnRenamed("month", "date"))
    errors = spark.createDataFrame([("v", 1, months[2])], "variable string, stock long, month date")
    assert [r.value for r in pit.clear_episodes(flat, errors).orderBy("month").collect()] == [5.0, 5.0, None, None, 5.1, 5.1]


def test_months_must_touch(spark):
    day = lambda s: pd.Timestamp(s).date()
    u = spark.createDataFrame([(1, day("2000-01-31"), 100.0, 10.0), (1, day("2000-02-29"), 110.0, 11.0), (1, day("2000-04-30"), 121.0, 12.0)], "stock long, month date, return_index double, market_cap double")
    got = universe.consecutive_returns(u).orderBy("month").collect()
    assert [None if r.ret is None else round(r.ret, 9) for r in got] == [None, 0.1, None] and [r.cap_lag for r in got] == [None, 10.0, None]


def test_common_stock_screen(spark):
    s = spark.createDataFrame([(1, "ABC", "ORD", "C"), (2, "ABC PREF", "ORD", "C"), (3, "ABC PREF", "FULLPAID", "C"), (4, "ABC", "PREF", "C"), (5, "ABC", None, "C"), (6, "ABC DEAD - PREF", "ORD", "C"), (7, "ABC DUPL SEE X", "ORD", "C"), (8, "ABC UNIT", "ORD", "C")], "stock long, ename string, code string, country string")
    p = spark.createDataFrame([("C", " PREF ", True), ("C", " UNIT ", False)], "country string, pattern string, overridable boolean")
    assert sorted(r.stock for r in listings.common_stocks(s, p).collect()) == [1, 2, 5, 6]


def test_two_dates_in_one_month_raise(spark):
    day = lambda s: pd.Timestamp(s).date()
    p = spark.createDataFrame([("v", 1, day("2000-01-03"), 1.0), ("v", 1, day("2000-01-31"), 2.0)], "variable string, stock long, date date, value double")
    with pytest.raises(Exception, match="two dates in one month"):
        imports.align_month_end(p).collect()
    with pytest.raises(ValueError, match="clash"):
        imports.readable_names(p, {"value": "stock"})


def test_regression_recovers_planted_slopes(spark):
    r = np.random.default_rng(1)
    d = pd.DataFrame({"month": np.repeat(np.arange(40), 150), "x1": r.normal(size=6000), "x2": r.normal(size=6000)})
    d["y"] = 0.002 + 0.01 * d.x1 - 0.005 * d.x2 + r.normal(size=6000) * 0.01
    got = statistics.grouped_ols2(spark.createDataFrame(d), "y", "x1", "x2", "month").toPandas()
    one = d[d.month == 3]
    want = np.linalg.lstsq(np.c_[np.ones(150), one.x1, one.x2], one.y, rcond=None)[0]
    assert np.allclose(got[got.month == 3][["b0", "b1", "b2"]].to_numpy()[0], want)
    assert abs(got.b1.mean() - 0.01) < 0.001 and abs(got.b2.mean() + 0.005) < 0.001


def edge_by_formula(o, h, low, c):
    """The published estimator on one window, from log prices; the first row only lends its previous values."""
    o, h, low, c = (np.log(np.asarray(x, float)) for x in (o, h, low, c))
    m = (h + low) / 2
    h1, l1, c1, m1 = h[:-1], low[:-1], c[:-1], m[:-1]
    o, h, low, m = o[1:], h[1:], low[1:], m[1:]
    r1, r2, r3, r4, r5 = m - o, o - m1, m - c1, c1 - m1, o - c1
    t = ((h != low) | (low != c1)).astype(float)
    po, pc = (t * (o != h)).mean() + (t * (o != low)).mean(), (t * (c1 != h1)).mean() + (t * (c1 != l1)).mean()
    if t.sum() < 2 or po == 0 or pc == 0:
        return None
    d1, d3, d5 = (r - t * r.mean() / t.mean() for r in (r1, r3, r5))
    x1, x2 = -4 / po * d1 * r2 - 4 / pc * d3 * r4, -4 / po * d1 * r5 - 4 / pc * d5 * r4
    e1, e2, v1, v2 = x1.mean(), x2.mean(), (x1**2).mean() - x1.mean() ** 2, (x2**2).mean() - x2.mean() ** 2
    s = (v2 * e1 + v1 * e2) / (v1 + v2) if v1 + v2 > 0 else (e1 + e2) / 2
    return min(max(np.sign(s) * np.sqrt(abs(s)), 0.0), 0.25)


def test_spread_equals_the_formula(spark):
    r = np.random.default_rng(2)
    close = 100 * np.exp(np.cumsum(r.normal(size=60) * 0.01))
    o, h, low, c = close * np.exp(r.normal(size=60) * 0.003), close * 1.01, close * 0.99, close * np.exp(r.choice([-1, 1], 60) * 0.005)
    p = panel(spark, [0.0] * 60, open=o, high=np.maximum(h, np.maximum(o, c)), low=np.minimum(low, np.minimum(o, c)), close=c)
    got = statistics.edge_spread(p).orderBy("date").toPandas()
    assert got.spread[:20].isna().all()
    for at in (20, 33, 59):
        w = got.iloc[at - 20 : at + 1]
        assert got.spread[at] == pytest.approx(edge_by_formula(w.open, w.high, w.low, w.close), rel=1e-6, abs=1e-9)
    assert statistics.edge_spread(panel(spark, [0.0] * 30, open=[1.0] * 30, high=[1.0] * 30, low=[1.0] * 30, close=[1.0] * 30)).where("spread is not null").count() == 0


def test_results_do_not_depend_on_partitions(spark, data):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("2", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append([QUERIES[k](spark, data).toPandas() for k in ("fo9_filter_pipeline", "pit8_attach", "ap3_decile_sorts")])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for a, b in zip(*out, strict=True):
        same_rows(a, b)


def test_many_regressors_equal_least_squares(spark):
    rng = np.random.default_rng(3)
    d = pd.DataFrame(rng.normal(size=(400, 4)), columns=["a", "b", "c", "e"])
    d["g"] = np.repeat(["x", "y"], 200)
    d["y"] = 0.5 + d.a - 2 * d.b + 0.1 * d.c + d.e
    d.loc[3, "b"] = np.nan
    d["twin"] = 2 * d.a
    s = spark.createDataFrame(d.astype(object).where(d.notna(), None), "a double, b double, c double, e double, g string, y double, twin double")
    got = {r.g: r for r in statistics.grouped_ols(s, "y", ["a", "b", "c"], "g", 100).collect()}
    for g, part in d.dropna().groupby("g"):
        x = np.column_stack([np.ones(len(part)), part[["a", "b", "c"]]])
        beta, *_ = np.linalg.lstsq(x, part.y, rcond=None)
        r = got[g]
        assert r.n == len(part) and [r.const, r.a, r.b, r.c] == pytest.approx(list(beta))
        assert r.r2 == pytest.approx(1 - (part.y - x @ beta).var(ddof=0) / part.y.var(ddof=0))
    assert all(r.a is None and r.r2 is None for r in statistics.grouped_ols(s, "y", ["a", "twin"], "g", 100).collect())
    assert statistics.grouped_ols(s, "y", ["a"], "g", 201).count() == 0


def test_factor_errors_equal_the_sandwich(spark):
    rng = np.random.default_rng(4)
    n, lags = 90, 4
    d = pd.DataFrame({"s": "one", "t": range(n), "m": rng.normal(size=n), "h": rng.normal(size=n)})
    d["y"] = 0.1 + d.m + 0.3 * d.h + np.convolve(rng.normal(size=n + 2), [1, 0.6, 0.3])[2 : n + 2]
    x = np.column_stack([np.ones(n), d.m, d.h])
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ d.y
    u = x * (d.y - x @ beta).to_numpy()[:, None]
    s = u.T @ u
    for k in range(1, lags + 1):
        c = u[k:].T @ u[:-k]
        s += (1 - k / (lags + 1)) * (c + c.T)
    se = np.sqrt(np.diag(inv @ s @ inv))
    got = {r.variable: r for r in statistics.hac_ols(spark.createDataFrame(d), "y", ["m", "h"], "s", "t", lags).collect()}
    for at, v in enumerate(["const", "m", "h"]):
        assert (got[v].coef, got[v].se, got[v].n) == (pytest.approx(beta[at]), pytest.approx(se[at]), n)


def test_spread_rank_equals_average_rank(spark):
    rng = np.random.default_rng(5)
    d = pd.DataFrame({"g": rng.integers(0, 3, 500), "v": np.concatenate([np.zeros(150), rng.normal(size=250).round(1), rng.lognormal(8, 4, 100)])})
    got = frames.spread_rank(spark.createDataFrame(d), "v", "r", "g").toPandas().sort_values(["g", "v"])
    want = d.assign(r=d.groupby("g").v.rank()).sort_values(["g", "v"])
    assert list(got.r) == list(want.r)


def test_padding_beside_the_life(spark):
    month = lambda k: (pd.Timestamp("2000-01-31") + pd.offsets.MonthEnd(k)).date()
    p = spark.createDataFrame([("v", 1, month(k), 5.0) for k in range(20)] + [("v", 2, month(k), 0.0) for k in range(4)], "variable string, stock long, month date, value double")
    uni = spark.createDataFrame([(1, month(k)) for k in range(2, 6)] + [(2, month(k)) for k in range(30)], "stock long, month date")
    life = spark.createDataFrame([(1, month(2), month(5), month(6)), (2, month(0), month(29), None)], "stock long, first_price date, last_price date, delisting_date date")
    r = checks.padding_and_staleness(p, uni, life, 3).first()
    assert (r.matched, r.dead_padded, r.after_last_price, r.before_first_price, r.after_delisting) == (24, 1.0, 14 / 24, 2 / 24, 13 / 24)
    assert (r.stale, r.stale_trading, r.zero_runs_trading, r.firms_stale) == (17 / 24, 3 / 8, 1 / 8, 0.5)


def test_files_and_registry(spark, tmp_path):
    a, b = f"{tmp_path}/007/part", f"{tmp_path}/012/part"
    spark.createDataFrame([(1, "x")], "code long, name string").write.parquet(a)
    spark.createDataFrame([(2, 3.0)], "code long, extra double").write.parquet(b)
    got = {(r.folder, r.code, r.name, r.extra) for r in imports.stack_files(spark, [a, b], r"/(\d+)/part").collect()}
    assert got == {("007", 1, "x", None), ("012", 2, None, 3.0)}
    lines = spark.createDataFrame([("# note",), ("",), ("A, b ,3",), ("C,d,x",)], "text string")
    assert [tuple(r) for r in imports.registry(lines, "code string, label string, scale int").collect()] == [("A", "b", 3), ("C", "d", None)]
    imports.write_by_country(spark.createDataFrame([(1, "X"), (2, "Y")], "stock long, country string"), f"{tmp_path}/out")
    assert {r.stock for r in spark.read.parquet(f"{tmp_path}/out").where("country = 'Y'").collect()} == {2}


def test_batches_beyond_a_thousand_lists(spark, tmp_path):
    """List numbers of four digits stay whole in the query and in its SQL; ids with one place are in order of their text."""
    n = 100_250
    orders = pd.DataFrame({"o_orderkey": np.arange(n) // 2 * 2, "o_custkey": np.arange(n)})
    orders.to_parquet(tmp_path / "orders.parquet")
    got = QUERIES["lst5_batches"](spark, str(tmp_path)).toPandas()
    with duckdb.connect() as db:
        db.register("orders", orders)
        want = db.sql(SQL["lst5_batches"]).df()
    assert set(got.itertuples(index=False, name=None)) == set(want.itertuples(index=False, name=None))
    assert (got.list == "L#A1002").sum() == 100 and (got.list == "L#A100").sum() == 100


def test_edge_spread_over_batches(spark):
    """Frames run on through batches of any size, no stock sees another's rows, and no frame of the engine sums its rows anew."""
    rng = np.random.default_rng(3)
    rows = []
    for stock in range(4):
        price = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 60)))
        for k in range(60):
            o, h, low, c = (float(v) for v in (price[k] * (1 + rng.normal(0, 0.004)), price[k] * 1.03, price[k] * 0.98, price[k] * (1 + rng.normal(0, 0.004))))
            rows.append((stock, k, None if stock == 2 and k == 30 else o, h, low, None if stock == 3 and k == 25 else c))
    panel = spark.createDataFrame(rows, "stock long, date int, open double, high double, low double, close double")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, got = spark.conf.get(name), []
    for size in ("7", "10000"):
        spark.conf.set(name, size)
        got.append({(r.stock, r.date): r.spread for r in statistics.edge_spread(panel).collect()})
    for stock in range(4):  # each stock alone
        got.append({(r.stock, r.date): r.spread for r in statistics.edge_spread(panel.where(F.col("stock") == stock)).collect()})
    spark.conf.set(name, before)
    assert got[0] == got[1] == {k: v for g in got[2:] for k, v in g.items()}
    assert {k for (s, k), v in got[0].items() if s == 0 and v is None} == set(range(20))
    assert {k for (s, k), v in got[0].items() if s == 3 and v is None} == {*range(20), *range(26, 46)}
    assert "RowFrame, -19" not in statistics.edge_spread(panel)._jdf.queryExecution().toString()
