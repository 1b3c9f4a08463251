"""Files on disk and hand-made rows: what is imported when, static snapshots, listing reports. Results are worked out by hand."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import listings as li
from ledgerline.sources import imports as im
from ledgerline.sources import incremental as inc
from ledgerline.sources import static_files as sf


def test_only_changed_variables_are_imported(spark, tmp_path):
    for name, rows in (("P/P_1.csv", 3), ("P/P_2.csv", 2), ("MV/MV_1.csv", 4)):
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text("stock,value\n" + "".join(f"{k},{k}.5\n" for k in range(rows)))
    panel, log = str(tmp_path / "panel"), str(tmp_path / "log")
    run = lambda: inc.import_changed(spark, str(tmp_path / "raw/*/*.csv"), r"/raw/([^/]+)/", "stock long, value double", panel, log)
    count = lambda: {r["variable"]: r["count"] for r in spark.read.parquet(panel).groupBy("variable").count().collect()}
    assert run() == ["MV", "P"] and count() == {"P": 5, "MV": 4}
    assert run() == [] and spark.read.parquet(log).count() == 2
    changed = tmp_path / "raw/P/P_2.csv"
    changed.write_text("stock,value\n9,1\n")
    os.utime(changed, (time.time() + 5, time.time() + 5))
    kept = sorted(os.listdir(tmp_path / "panel/variable=MV"))
    assert run() == ["P"] and count() == {"P": 4, "MV": 4} and sorted(os.listdir(tmp_path / "panel/variable=MV")) == kept
    logged = im.latest_log(spark.read.parquet(log).withColumn("status", F.lit("ok")))
    assert {r["variable"]: r["rows"] for r in logged.collect()} == {"P": 4, "MV": 4} and spark.read.parquet(log).count() == 3


def test_writing_counts_as_it_writes(spark, tmp_path):
    d = spark.createDataFrame([("AT", 1, None), ("AT", 2, 2.0), ("DE", 3, 3.0)], "country string, stock long, value double")
    path = str(tmp_path / "out")
    assert inc.write_observed(d, path, ["country"], values=F.count("value"), last=F.max("stock")) == {"rows": 3, "values": 2, "last": 3}
    assert inc.write_observed(d.where("country = 'DE'").withColumn("value", F.lit(9.0)), path, ["country"]) == {"rows": 1}
    assert sorted((r.country, r.value) for r in spark.read.parquet(path).where("value is not null").collect()) == [("AT", 2.0), ("DE", 9.0)]


def test_static_snapshots_from_files(spark, tmp_path):
    text = {
        "2024-01-31/X_1.csv": "Type,X\n902242,AA\n12345,BB\nU1,$$ER: E100\nU2,#NA\n,CC\nU3,DD\n",
        "2024-01-31/X_2.csv": "Type,X\nU3,EE\nU4,AA\n",
        "2024-06-30/X_1.csv": "Type,X\n902242,AA\n012345,ZZ\nU4,\nU5,QQ\n",
        "2024-06-30/X_9.csv": "Type,X\nU9,$$ER: none\n",
    }
    for name, body in text.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    typed = sf.typed_cells(sf.read_cells(spark, [str(tmp_path / "*/*.csv")], "Type", "X"))
    report = {(r.file, r.as_of.month): r for r in sf.file_reports(typed).collect()}
    one = report["X_1.csv", 1]
    assert (one.series, one.firms, one.missing, one.errors, one.examples, one.padded, one.blank, one.type, one.status) == (5, 3, 1, 1, "$$ER: E100", 1, 1, "text", "ok")
    assert report["X_9.csv", 6].status == "no_data"
    panel = sf.snapshots(typed)
    assert {(r.stock, r.as_of.month): (r.value, r.repeats) for r in panel.collect()} == {("902242", 1): ("AA", 0), ("012345", 1): ("BB", 0), ("U3", 1): ("DD", 1), ("U4", 1): ("AA", 0), ("902242", 6): ("AA", 0), ("012345", 6): ("ZZ", 0), ("U5", 6): ("QQ", 0)}
    assert [tuple(r) for r in sf.snapshot_report(panel).orderBy("as_of").collect()] == [(dt.date(2024, 1, 31), 4, 3, 1, 0, 0), (dt.date(2024, 6, 30), 3, 3, 0, 2, 1)]
    assert ("AA", 2) in [(r.value, r.firms) for r in sf.value_distribution(panel).collect()]


def test_types_by_majority_and_coerced_cells(spark):
    rows = [("f", dt.date(2024, 1, 1), k, f"U{k}", False, c) for k, c in enumerate(["2024-12-31", "2024-06-30", "soon", None])]
    typed = sf.typed_cells(spark.createDataFrame(rows, "file string, as_of date, line long, id string, numeric boolean, cell string"))
    r = sf.file_reports(typed).first()
    assert (r.type, r.coerced, r.firms, r.missing) == ("date", 1, 2, 1)
    assert {(x.value, x.firms) for x in sf.value_distribution(sf.snapshots(typed), dates=True).collect()} == {("12", 1), ("6", 1)}


def test_inventory_states(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    registry = make([("a", "timeseries"), ("b", "timeseries"), ("c", "timeseries")], "variable string, type string")
    raw = make([(v, 2, 5) for v in "abdef"], "variable string, n_files int, raw_at int")
    panel = make([("b", 6), ("d", 4), ("e", 9)], "variable string, panel_at int")
    log = make([("e", "incomplete", 10, 7), ("f", "incomplete", 1, 0), ("b", "complete", 3, 2)], "variable string, status string, n_series int, n_firms int")
    got = {r.variable: r for r in im.inventory(registry, raw, panel, log, make([("m2", "b"), ("m1", "b")], "name string, variable string")).collect()}
    assert {k: r.state for k, r in got.items()} == {"a": "missing", "b": "current", "c": "missing", "d": "stale", "e": "incomplete", "f": "blocked"}
    assert got["b"].in_merged == "m1, m2" and got["b"].share_with_data == 0.667 and not got["d"].registered


@pytest.mark.parametrize("parts", [1, 4])
def test_lists_keep_the_order_of_the_input(spark, parts):
    ids = ["9", "1", "92407X", "5", "1", " 9 ", "", None, "E12"] + [f"n{k}" for k in range(300, 0, -1)]
    d = spark.createDataFrame([(i,) for i in ids], "stock string").coalesce(1).withColumn("at", F.monotonically_increasing_id()).repartition(parts)
    got = sorted((r.list, r.row, r.stock) for r in li.batches(d, 2, "EU").collect())
    assert [s for _, _, s in got][:5] == ["9", "1", "92407X", "5", "E12"] and got[0][0] == "L#EU001" and got[-1][:2] == ("L#EU153", 1) and len(got) == 305


def test_listing_warnings(spark):
    rows = [("f1", "AT", "VIENNA", "Equities", i) for i in range(6)] + [("f1", "AT", "FRANKFURT", "Equities", 10 + i) for i in range(7)] + [("f1", "AT", "NOWHERE", "Equities", 20 + i) for i in range(4)]
    rows += [("f1", "CH", "VIENNA", "Equities", 5), ("f1", "AT", "-", "Equities", 30), ("f1", "AT", None, "Equities", 31), ("f1", "AT", "VIENNA", "Warrants", 32), ("f2", "LI", "X", "Equities", 40), ("f3", "SE", "OSLO", "Equities", 41)]
    lines = spark.createDataFrame(rows, "file string, country string, exchange string, category string, stock long")
    venues = spark.createDataFrame([("AT", "vienna"), ("DE", "frankfurt"), ("SE", "^$")], "country string, pattern string")
    got = {tuple(r) for r in li.exchange_warnings(lines, venues, spark.createDataFrame([("AT",), ("NO",)], "country string")).collect()}
    assert got == {
        ("AT", "several countries", "AT; CH"), ("AT", "no equities", "1"), ("AT", "largest exchange abroad", "FRANKFURT"), ("AT", "large unknown exchange", "NOWHERE"), ("AT", "large unknown exchange", ""), ("AT", "no exchange name", "2"),
        ("AT", "repeated ids", "1"), ("LI", "no pattern", ""), ("SE", "no domestic line", ""), ("SE", "large unknown exchange", "OSLO"), ("NO", "no file", ""),
    } - {("AT", "large unknown exchange", "")}


def test_domiciles(spark):
    d = spark.createDataFrame([("AUSTRIA", " austria"), ("AUSTRIA", None), ("AUSTRIA", "GERMANY"), ("ITALY", "ITALY ")], "country string, domicile string")
    assert {r.country: (r.n, round(r.matching, 3)) for r in li.domicile_match(d).collect()} == {"AUSTRIA": (3, 0.333), "ITALY": (1, 1.0)}
    assert li.domicile_mismatches(d).count() == 2
