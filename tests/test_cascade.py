"""The whole order on a hand-made panel: which step takes which row, worked out from the rules."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import cascade

US = "UNITED STATES"
STEP = {n: k for k, n in enumerate(cascade.US_STEPS, 1)}
DAY = dt.date(1994, 1, 3)


def series(stock, n, index=None, **more):
    """n rows on consecutive days; the index goes up and down by 1 and 2 percent unless given."""
    level, rows = 100.0, []
    for i in range(n):
        level *= 1.02 if i % 2 else 0.99
        row = {"stock": stock, "date": DAY + dt.timedelta(i), "return_index": index(i) if index else level, "open": 10.0, "high": 12.0 + i, "low": 8.0, "close": 10.0, "volume": 5.0, "unadj_close": 10.0, "adj_factor": 1.0}
        rows.append(row | {k: f(i) for k, f in more.items()})
    return rows


def marked(spark, rows, delisted=None, **limits):
    stocks = sorted({r["stock"] for r in rows})
    fields = "stock string, date date, return_index double, open double, high double, low double, close double, volume double, unadj_close double, adj_factor double"
    panel = spark.createDataFrame([[r[c.split()[0]] for c in fields.split(", ")] for r in rows], fields)
    dates = delisted or {}
    statics = spark.createDataFrame([(s, f"{s} CORP", "ORD", None, f"I{s}", "P", "U$", US, dates.get(s)) for s in stocks if s != "stranger"], "stock string, ename string, code string, loc string, isin string, isinid string, currency string, country string, delisting_date date")
    statics = statics.withColumn("ename", F.when(F.col("stock") == "reit", "A REIT CORP").otherwise(F.col("ename"))).withColumn("currency", F.when(F.col("stock") == "euro", "E").otherwise(F.col("currency")))
    tables = [spark.createDataFrame(r, s) for r, s in (([(US, " REIT ", False)], "country string, pattern string, overridable boolean"), ([(US, "")], "country string, pattern string"), ([(US, "U$")], "country string, currency string"))]
    limits = {"after": "1990-01-01", "until": "2030-01-01", "history": 5, "penny": 0.0, **limits}
    out = cascade.us_order(panel, statics, cascade.first_static_failure(statics, *tables), **limits)
    return out, {(r.stock, (r.date - DAY).days): r for r in out.collect()}


def gone(rows, stock):
    """Steps by day. On the panel's first day no stock has a return yet, so the holiday screen takes what is left of it."""
    steps = [rows[k].gone for k in sorted(k for k in rows if k[0] == stock)]
    return [None if steps[0] == STEP["(16) holidays"] else steps[0], *steps[1:]]


def test_each_step_takes_its_rows(spark):
    n = 30
    rows = series("fine", n) + series("none", n, lambda i: None) + series("reit", n) + series("euro", n) + series("stranger", n) + series("up", n, lambda i: 100.0 * 1.01**i) + series("zero", n, lambda i: 100.0 + (i == 20))
    rows += series("stale", n, lambda i: 100.0 + i * 0.5 * (-1) ** i if i < 12 or i > 17 else 100.0) + series("jump", n, lambda i: 100.0 + i % 3 if i != 9 else 1000.0) + series("gap", n, adj_factor=lambda i: 1.2 if i == 4 else 1.0)
    rows += series("free", n, unadj_close=lambda i: 0.0 if i == 3 else 10.0, close=lambda i: 0.0 if i == 3 else 10.0, open=lambda i: 8.0, low=lambda i: 0.0 if i == 3 else 8.0) + series("odd", n, high=lambda i: 9.0 if i == 6 else 12.0 + i) + series("flat", n, high=lambda i: 12.0)
    rows += series("late", n, volume=lambda i: None if i < 3 else 5.0, open=lambda i: None if i == 10 else 9.0)
    out, got = marked(spark, rows, run=5, zero=0.85, high=3.0)
    whole = {"none": "(11) without return index", "reit": "(1) non-common", "euro": "(5) foreign currency", "stranger": "(1) non-common", "up": "(7) implausible returns", "zero": "(8) zero returns"}
    for stock, name in whole.items():
        assert gone(got, stock) == [STEP[name]] * n, stock
    part = {"stale": ("(14) stale prices", {17}), "jump": ("(15) outlier errors", {9, 10}), "gap": ("(18) adjustment inconsistencies", {4}), "free": ("(19) nonsense values", {3}), "odd": ("(own) implausible prices", {6})}
    part |= {"flat": ("(own) no trading activity", set(range(2, n))), "late": ("(own) leading missings", {1, 2}), "fine": ("", set())}
    for stock, (name, at) in part.items():
        assert gone(got, stock) == [STEP[name] if i in at else None for i in range(n)], stock
    assert got["late", 10].filled and got["late", 10].open == 9.0 and not got["late", 11].filled
    report = {(r.step, r.country): (r.stocks, r.rows) for r in cascade.filter_report(out.withColumn("country", F.lit("US")), cascade.US_STEPS).collect()}
    assert report[0, "TOTAL"] == (14, 14 * n) and report[STEP["(11) without return index"], "US"] == (13, 13 * n) and report[STEP["(1) non-common"], "US"] == (11, 11 * n)
    assert report[len(cascade.US_STEPS), "TOTAL"] == (8, sum(r.gone is None for r in got.values()))


def test_padding_and_delisting(spark):
    """Of the padded days before a delisting the first nine stay; later days go; the last day takes the delisting return."""
    rows = series("fine", 31) + series("dead", 31, lambda i: 100.0 + i % 2 if i < 15 else 100.5)
    _, got = marked(spark, rows, {"dead": DAY + dt.timedelta(28)})
    assert gone(got, "dead") == [None] * 25 + [STEP["(13) padded values before delisting"]] * 6
    last = got["dead", 24]
    assert last.delisted and abs(last.ret + 0.35) < 1e-12 and abs(last.return_index - 100.5 * 0.65) < 1e-12
    _, got = marked(spark, rows, {"dead": DAY + dt.timedelta(28)}, keep=0)
    assert gone(got, "dead").count(None) == 16  # the day on which the index last moved stays


def test_short_history_and_holidays(spark):
    rows = [r for s in "abcd" for r in series(s, 12)] + series("new", 4)
    moved = [r | {"date": r["date"] + dt.timedelta(8)} if r["stock"] == "new" else r for r in rows]
    _, got = marked(spark, rows)
    assert gone(got, "new") == [STEP["(12) short history"]] * 4
    _, got = marked(spark, moved)  # as short, but at the panel's end
    assert gone(got, "new") == [None] * 4
    idle = [r | {"return_index": 100.0 + (r["date"].day if r["date"] not in (DAY + dt.timedelta(5), DAY + dt.timedelta(6)) else 7)} for r in rows if r["stock"] != "new"]
    _, got = marked(spark, idle, active=0.5, run=99, one_sign=1.0)
    assert [i for i, g in enumerate(gone(got, "a")) if g == STEP["(16) holidays"]] == [5, 6]


def test_duplicate_days_and_penny_months(spark):
    rows = series("a", 60) + series("a", 2) + series("b", 60, unadj_close=lambda i: 1.0, close=lambda i: 1.0, open=lambda i: 1.0, low=lambda i: 1.0)
    fields = [g for k, r in marked(spark, rows, penny=0.5)[1].items() if r.date > DAY for g in [(k[0], r.date.month, r.gone)]]
    assert {g for s, m, g in fields if s == "b" and m == 1} == {None} and {g for s, m, g in fields if s == "b" and m > 1} == {STEP["(21) penny stocks"]}
    assert {g for s, _, g in fields if s == "a"} <= {None, 1}
    assert marked(spark, rows)[0].where(F.col("gone") == STEP["(0) duplicate days"]).count() == 2


def test_no_part_runs_twice(spark):
    """What is returned is read from the written parts: no window of the order is left in its plan, for the months' cut or for the rows."""
    out = marked(spark, series("a", 40) + series("b", 40))[0]
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
