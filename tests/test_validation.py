"""Emission tables, comparisons, event studies, diagnostics and the battery on hand-made rows; results are worked out from the rules."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import checks as q
from ledgerline.operators import diagnostics as dg
from ledgerline.operators import emissions as em
from ledgerline.operators import relations as rel
from ledgerline.operators import series as sr
from ledgerline.operators import statistics as st
from ledgerline.sources import incremental as inc

ITEMS = {"reported": ["total", "scope1", "scope2"], "scopes": ["scope1", "scope2"], "estimate": "estimate"}


def end(year, month):
    return dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(1)


def wide(spark, rows):
    return spark.createDataFrame(rows, "stock long, month date, total double, scope1 double, scope2 double, estimate double")


def test_emissions_on_december_rows(spark):
    """Values of other months, and rows outside the universe, do not count."""
    w = wide(spark, [(1, end(2020, 12), 10.0, None, None, 10.005), (1, end(2020, 6), 10.0, None, None, 20.0), (2, end(2020, 12), None, 4.0, None, None), (3, end(2020, 12), None, None, None, 7.0), (4, end(2020, 12), 5.0, 1.0, 2.0, 6.0), (9, end(2020, 12), 1.0, None, None, None)])
    uni = spark.createDataFrame([(s, end(2020, m), c, g) for s, c, g in ((1, 40.0, 1), (2, 30.0, 1), (3, 20.0, 2), (4, 10.0, 2), (5, 100.0, 2)) for m in (6, 12)], "stock long, month date, market_cap double, size_group int")
    got = {r.field: (r.n, round(r.ew, 3), round(r.vw, 3)) for r in em.coverage_by_year(w, uni, ITEMS).collect()}
    assert got == {"total": (2, 0.4, 0.25), "scope1": (2, 0.4, 0.2), "scope2": (1, 0.2, 0.05), "estimate": (3, 0.6, 0.35), "any_reported": (3, 0.6, 0.4), "scope12_reported": (1, 0.2, 0.05), "estimated": (3, 0.6, 0.35), "reported_or_estimated": (4, 0.8, 0.5), "estimated_only": (1, 0.2, 0.1)}
    r = em.reported_vs_estimated(w, "total", "estimate").first()
    assert (r.year, r.reported_only, r.estimated_only, r.both, r.share_equal) == (2020, 1, 1, 2, 0.5) and r.median == pytest.approx((1.0005 + 1.2) / 2)
    counts = {r.group: (r.stocks, r.stock_years, r.share) for r in em.firm_counts(w, uni, ITEMS, 2020).collect()}
    assert counts["universe"] == (5, 5, 1.0) and counts["any_reported"] == (3, 3, 0.6) and counts["estimated_only"] == (1, 1, 0.2)
    sizes = {(r.year, r.size_group): r.share for r in em.coverage_by_size(w, uni, ITEMS).collect()}
    assert sizes == {(2020, 1): 1.0, (2020, 2): pytest.approx(2 / 3)}


def test_overview_keeps_variables_without_data(spark):
    p = spark.createDataFrame([("a", s, end(2000 + y, 12), float(s * y)) for s in range(3) for y in range(2)], "variable string, stock long, month date, value double")
    got = {r.variable: r for r in em.raw_overview(p, spark.createDataFrame([("a",), ("b",)], "variable string"), (3, 4)).collect()}
    assert got["b"].firms == 0 and got["b"].first is None and got["a"].firm_months == 6
    assert (got["a"].first_year_3_firms, got["a"].first_year_4_firms, got["a"].share_zero, got["a"].median_distinct_values) == (2000, None, pytest.approx(4 / 6), 2.0)


def test_example_events(spark, tmp_path):
    w = wide(spark, [(1, end(2020, 1), None, 1.0, None, None), (1, end(2020, 2), None, 1.0, None, None), (1, end(2020, 3), 5.0, None, None, None), (2, end(2020, 1), 1.0, None, None, None)])
    reports = spark.createDataFrame([(1, end(2020, 3)), (1, end(2020, 5)), (1, end(2019, 5)), (7, end(2020, 1))], "stock long, month date")
    few = spark.createDataFrame([(1, "ONE"), (7, "SEVEN")], "stock long, ename string")
    fye = spark.createDataFrame([(1, 6)], "stock long, fye_month int")
    got = {r.month: (r.changed, r.accounts, r.total, r.fye_month) for r in em.example_events(w, reports, few, fye, 2020).collect()}
    assert got == {end(2020, 1): ("scope1", False, None, 6), end(2020, 3): ("total,scope1", True, 5.0, 6), end(2020, 5): ("", True, None, 6)}
    sizes = inc.write_report({"w": w, "few": few}, str(tmp_path))
    assert {tuple(r) for r in sizes.collect()} == {("w", 4), ("few", 2)} and spark.read.parquet(f"{tmp_path}/w").count() == 4


def hac(y, xs, lags):
    """Coefficients and t by the sandwich formula, as in a textbook."""
    x = np.column_stack([np.ones(len(y)), *xs])
    b = np.linalg.solve(x.T @ x, x.T @ y)
    u = x * (y - x @ b)[:, None]
    s = u.T @ u
    for k in range(1, lags + 1):
        g = u[k:].T @ u[:-k]
        s += (1 - k / (lags + 1)) * (g + g.T)
    inverse = np.linalg.inv(x.T @ x)
    return b, b / np.sqrt(np.diag(inverse @ s @ inverse))


def test_market_and_factor_comparisons(spark):
    rng = np.random.default_rng(4)
    n = 60
    market, rf = rng.normal(0.005, 0.04, n), rng.uniform(0, 0.003, n)
    port = rf + 0.001 + 1.1 * market + rng.normal(0, 0.01, n)
    months = [end(2000 + k // 12, k % 12 + 1) for k in range(n)]
    rows = [("p", *v) for v in zip(months, port.tolist(), market.tolist(), rf.tolist(), strict=True)]
    r = st.compare_to_market(spark.createDataFrame([*rows, ("p", end(2010, 1), None, 0.1, 0.0)], "key string, month date, port double, mkt_rf double, rf double"), "key", "month", 12, 6).first()
    b, t = hac(port - rf, [market], 6)
    whole = market + rf
    assert (r.n, r.start, r.end) == (n, months[0], months[-1])
    np.testing.assert_allclose([r.alpha, r.beta, r.alpha_t, r.beta_t, r.alpha_annual], [*b, *t, 12 * b[0]], rtol=1e-8)
    np.testing.assert_allclose([r.corr, r.mean_diff, r.tracking_error, r.vol_mkt], [np.corrcoef(port, whole)[0, 1], 12 * (port - whole).mean(), math.sqrt(12) * (port - whole).std(ddof=1), math.sqrt(12) * whole.std(ddof=1)], rtol=1e-8)
    f = st.compare_factors(spark.createDataFrame([("f", m, a, c) for m, a, c in zip(months, port.tolist(), market.tolist(), strict=True)] + [("short", months[0], 1.0, 1.0)], "factor string, month date, mine double, bench double"), 6).collect()
    assert [x.factor for x in f] == ["f"] and f[0].slope == pytest.approx(np.polyfit(port, market, 1)[0])  # the published on the own
    assert f[0].t_mine == pytest.approx(hac(port, [], 6)[1][0]) and f[0].mean_bench == pytest.approx(12 * market.mean())


def test_cohort_spread(spark):
    """Earnings shocks of some cohorts move returns in the month after; the spread is the mean over cohorts, not over events."""
    rng = random.Random(3)
    snaps, returns = [], []
    for cohort in range(4):
        for k in range(10):
            stock, month = cohort * 100 + k, end(2001, 3 + cohort)
            snaps.append((stock, month, end(2000, 3 + cohort), float(k), 0.0, 10.0, month))
            for j in range(-1, 3):
                returns.append((stock, end(2001, 3 + cohort + j), (0.01 * (cohort + 1) if k >= 5 else 0.0) * (j == 1) + rng.gauss(0, 1e-6)))
    snaps += [(900, end(2001, 3), end(2000, 9), 5.0, 0.0, 10.0, end(2001, 3)), (901, end(2001, 3), end(2000, 3), 5.0, 0.0, 0.0, end(2001, 3)), (902, end(2001, 3), end(2000, 3), 5.0, None, 3.0, end(2001, 3))]  # too soon, no base, no value before
    e = st.earnings_events(spark.createDataFrame(snaps, "stock long, report_month date, prev_report_month date, ni double, ni_prev double, ta_prev double, fye date"), "ni", "ta")
    assert e.count() == 40
    got = {r.k: r for r in st.cohort_spread(e, spark.createDataFrame(returns, "stock long, month date, ret double"), -1, 2, 2).collect()}
    steps = np.array([0.01, 0.02, 0.03, 0.04])
    assert got[1].cohorts == 4 and got[1].spread == pytest.approx(steps.mean(), abs=1e-5) and got[1].t == pytest.approx(steps.mean() / (steps.std(ddof=1) / 2), rel=1e-2)
    assert abs(got[0].spread) < 1e-5


def test_value_consistency(spark):
    rows = [(s, "DE", n, end(2000, 1 + m), 2.0, b) for s, n, b in ((1, "Alpha AG", 0.5), (2, "Beta SER. A", 0.8), (3, "BETA 'B' DEAD - 1/1/01", 0.5), (4, "Gamma", 0.5 / 1.95583), (5, "Delta", 0.8), (6, "Eps", 0.1)) for m in range(3)]
    rows.append((1, "DE", "Alpha AG", end(2001, 1), 2.0, -9.0))
    c = spark.createDataFrame([(4, "DM"), (6, "FF"), (1, "E")], "stock long, currency string")
    got = {r.stock: r for r in dg.value_consistency(spark.createDataFrame(rows, "stock long, country string, name string, month date, mtbv double, bm double"), c).collect()}
    assert {s: r.category for s, r in got.items()} == {1: "ok", 2: "share_class", 3: "ok", 4: "legacy_currency", 5: "other", 6: "other"}
    assert got[1].months == 3 and got[4].expected_legacy_ratio == pytest.approx(1 / 1.95583)
    stems = spark.createDataFrame([("Beta SER. A",), ("beta 'B' DEAD - x",), ("A.B. One Two Three Four",), (None,)], "n string").select(dg.name_stem(F.col("n"))).collect()
    assert [r[0] for r in stems] == ["BETA", "BETA", "ONE TWO THREE", ""]


def test_shares_basis(spark):
    """Shares in thousands that fit the unadjusted price at the fiscal year end; the adjusted one is half of it from then on."""
    rows = [(s, end(2001, m), "AT", 1000.0, 5.0, 10.0, 100_000.0 if s < 4 else None, end(2001, 4) if m > 5 else None) for s in range(1, 5) for m in range(1, 9)]
    b = spark.createDataFrame(rows, "stock long, month date, country string, market_cap double, price double, price_unadjusted double, shares double, report_month date")
    got = {r.basis: r for r in dg.shares_basis(dg.shares_ratios(b)).collect()}
    assert got["unadjusted"].lines == 3 and got["unadjusted"].within == 1.0 and got["adjusted"].within == 0.0


def test_relations_engine(spark):
    rules = (rel.Rule("id", "identity", "a", "b + c", 0.01), rel.Rule("le", "le", "a", "b", 0.1), rel.Rule("rg", "range", "a / c", lower=0.0, upper=2.0, condition="b > 1"), rel.Rule("cm", "compare", "a", "2 * b / c"), rel.Rule("no", "le", "a", "zz"), rel.Rule("off", "le", "d", "a"))
    rows = [(1, end(2000, 12), 3.0, 2.0, 1.0, None), (2, end(2000, 12), 5.0, 2.0, 1.0, None), (3, end(2001, 12), 0.0, 0.0, 0.0, None), (4, end(2001, 12), 1.0, 1.0, 0.0, None), (5, end(2001, 12), None, 1.0, 1.0, None)]
    d = spark.createDataFrame(rows, "stock long, month date, a double, b double, c double, d double")
    cells = rel.evaluated(d, rules)
    got = {r.relation: r for r in rel.summary(d, cells, rules).collect()}
    assert (got["id"].n, got["id"].violations, got["id"].both_zero) == (4, 0.25, 0.25) and got["le"].violations == pytest.approx(0.5)
    assert (got["rg"].n, got["rg"].violations, got["rg"].median_ratio) == (2, 1.0, None)  # a / 0 is unknown
    assert got["cm"].violations is None and got["cm"].n == 2 and got["no"].status == "skipped (missing zz)" and got["off"].status == "no overlapping observations"
    assert {(r.relation, r.year): r.violations for r in rel.by_year(cells).collect()}["le", 2000] == 1.0
    assert [(r.relation, r.stock, r["rank"]) for r in rel.examples(cells, most=1).orderBy("relation").collect()] == [("id", 2, 1), ("le", 1, 1), ("rg", 1, 1)]


def test_battery_levels_are_of_firm_years(spark):
    """A value that stands in twelve months counts once; bins of changes are by year and keep 4 apart from 5 and more."""
    rows = [("v", s, end(2000, m), float(s)) for s in range(1, 4) for m in range(1, 13)] + [("v", 9, end(2000, m), float(m if m < 6 else 5)) for m in range(1, 13)] + [("v", 10, end(2000, 12), 1000.0)]
    p = spark.createDataFrame(rows, "variable string, stock long, month date, value double")
    u = q.update_frequency(p).first()
    assert (u.year, u.firm_years, u.none, u.four, u.more) == (2000, 4, 0.75, 0.25, 0.0)
    y, k = q.yearly_overview(p).first(), q.yearly_quantiles(p).first()
    assert (y.firms, y.n, y.months_per_firm, y.median, k.p50, k.n) == (5, 49, 9.8, 3.0, 3.0, 5) and y.mean == pytest.approx((1 + 2 + 3 + 5 + 1000) / 5)
    assert {"p5", "p95"} <= set(k.asDict())


def test_errors_per_thousand_firms(spark):
    c = spark.createDataFrame([("a,b,c", True), ("a,b", False), ("a,c,d", True)], "variables string, error boolean")
    p = spark.createDataFrame([(v, s) for v in "abcde" for s in range(4)], "variable string, stock long")
    assert {r.variable: (r.errors, r.per_thousand) for r in q.error_counts(c, p).collect()} == {"a": (2, 500.0), "b": (1, 250.0), "c": (2, 500.0), "d": (1, 250.0), "e": (0, 0.0)}


def test_outside_the_universe(spark):
    p = spark.createDataFrame([("v", 1, end(2000, 1), 1.0), ("v", 2, end(2000, 1), 1.0), ("v", 3, end(2000, 1), 1.0), ("v", 3, end(2000, 2), 1.0)], "variable string, stock long, month date, value double")
    uni = spark.createDataFrame([(1, end(2000, 1), 30.0), (2, end(2000, 1), None), (4, end(2000, 1), 10.0), (4, end(2000, 3), 5.0)], "stock long, month date, market_cap double")
    got = {r.month.month: r for r in q.coverage_by_month(p, uni).collect()}
    assert (got[1].n, got[1].n_value, got[1].cap, got[1].cap_value, got[1].vw, got[1].n_outside) == (3, 2, 40.0, 30.0, 0.75, 1) and (got[3].n_value, got[3].vw) == (0, 0.0) and 2 not in got


def test_series(spark):
    s = spark.createDataFrame([(end(2000, m), 0.1 * m, 0.1) for m in range(1, 5)], "month date, a double, b double")
    assert [round(r.deviation, 6) for r in sr.largest_deviations(s, "a", "b", 2).collect()] == [0.3, 0.2]
    assert sr.cumulative(s, "b").orderBy("month").collect()[-1].cumulative == pytest.approx(1.1**4 - 1, abs=1e-7)
    assert {r.window: round(r.total, 6) for r in sr.window_sums(sr.numbered(s), "a", {"x": (1, 2), "y": (2, 4)}).collect()} == {"x": 0.3, "y": 0.9}
    rates = spark.createDataFrame([(end(1999, 12), 1.0), (end(2000, 1), 1.2)], "month date, rate double")
    there = sr.to_currency(s, sr.rate_changes(rates), "a", "usd")
    assert there.first().usd == pytest.approx(1.1 * 1.2 - 1) and sr.to_currency(there, sr.rate_changes(rates), "usd", "eur", back=True).first().eur == pytest.approx(0.1)
