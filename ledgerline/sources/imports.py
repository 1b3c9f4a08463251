"""Import jobs: wide vendor frames to long tables, reports of what was read, static snapshots, factor text, exchange rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import months_between
from ledgerline.functions.frames import by, first_rows

# Fixed value: the pattern of a series header and its id.
HEADER = r"^\s*(?:DPL#\()?([^(\s]+)\("


def series_id(header: Column) -> Column:
    """SRC3, SRC8: the id in a header DPL#(<id>(VAR)), null if there is none."""
    return F.nullif(F.regexp_extract(header, HEADER, 1), F.lit(""))


def fix_ids(headers: DataFrame) -> DataFrame:
    """SRC3: adds to each header its id (`stock`; the header itself where it holds none) and whether it held one."""
    own = series_id(F.col("header"))
    return headers.withColumns({"stock": F.coalesce(own, "header"), "matched": own.isNotNull()})


def to_numbers(wide: DataFrame, date: str = "Date") -> DataFrame:
    """SRC2: all columns but the date as numbers; cells that are none become null."""
    return wide.select(date, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in wide.columns if c != date])


def melt(wide: DataFrame, date: str = "Date", value: str = "value") -> DataFrame:
    """SRC4: one row for each date and column, with the column's name as `header`; cells must be of one type."""
    return wide.unpivot(date, [c for c in wide.columns if c != date], "header", value)


def wide_to_long(wide: DataFrame, date: str = "Date") -> DataFrame:
    """SRC1, SRC2, SRC4: one row for each date and series with the raw cell and its number; error columns are left out."""
    columns = [c for c in wide.columns if c != date and not c.startswith("#ERROR")]
    long = wide.select(F.col(date).cast("string").alias("raw_date"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot("raw_date", columns, "header", "cell")
    return long.withColumns({"stock": F.coalesce(series_id(F.col("header")), "header"), "date": F.try_to_date("raw_date", "yyyy-MM-dd"), "value": F.col("cell").try_cast("double")})


def file_report(long: DataFrame) -> DataFrame:
    """SRC7: for each file: series, unparsed ids, observations, bad dates, coerced cells with five examples, duplicates, status."""
    filled = F.coalesce(F.trim("cell"), F.lit("")) != ""
    coerced = filled & F.col("value").isNull()
    keys = long.where("date is not null and value is not null").groupBy("file", "stock", "date").agg(F.count("*").alias("n"))
    twice = keys.groupBy("file").agg(F.sum(F.col("n") - 1).alias("duplicates"), F.count_distinct("stock").alias("firms"))
    r = long.groupBy("file").agg(F.count_distinct("header").alias("series"), F.count_distinct(F.when(series_id(F.col("header")).isNull(), F.col("header"))).alias("unparsed"), F.count_if(F.expr("date is not null and value is not null")).alias("obs"), F.count_distinct(F.when(F.col("date").isNull(), F.col("raw_date"))).alias("bad_dates"), F.count_if(coerced).alias("coerced"), F.array_join(F.slice(F.array_sort(F.collect_set(F.when(coerced, F.col("cell")))), 1, 5), ",").alias("examples"))
    r = r.join(twice, "file", "left").na.fill(0, ["duplicates", "firms"])
    return r.withColumn("status", F.when(F.col("obs") == 0, "empty").when(F.col("bad_dates") > 0, "check").otherwise("ok"))


def merge_items(long: DataFrame, items: list[str]) -> DataFrame:
    """SRC5: one row for each firm and date with a column for each item, from long rows (stock, date, item, value) stacked of all items: one
    shuffle, and no row without any item."""
    return long.groupBy("stock", "date").pivot("item", items).agg(F.max("value"))


def of_countries(panel: DataFrame, statics: DataFrame, countries: list[str]) -> DataFrame:
    """SRC20: the panel's rows of some countries, with their country."""
    return panel.join(statics.where(F.col("country").isin(countries)).select("stock", "country"), "stock")


def market_country(lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """SRC26: country of each index line by the last word of its market's name (aliases: word, country); names of no country go."""
    return lines.withColumn("word", F.element_at(F.split("market", " "), -1)).join(aliases, "word").drop("word")


def holding_variables(datasets: DataFrame, gone: list[str]) -> DataFrame:
    """DG5: datasets (dataset, variable) that hold variables which are to be dropped, and how many."""
    return datasets.where(F.col("variable").isin(gone)).groupBy("dataset").agg(F.count_distinct("variable").alias("dropped"))


def merge_files(long: DataFrame) -> DataFrame:
    """SRC10: known values of all files; of one firm and date the first file wins."""
    return first_rows(long.where("date is not null and value is not null"), ["stock", "date"], ["file", "value"]).select("stock", "date", "value", "file")


def conflicts(long: DataFrame) -> DataFrame:
    """SRC10: firm-dates in several files, and how many of them differ in value."""
    g = long.where("date is not null and value is not null").groupBy("stock", "date").agg(F.count("*").alias("n"), F.count_distinct("value").alias("k")).where("n > 1")
    return g.agg(F.count("*").alias("repeated"), F.count_if(F.col("k") > 1).alias("conflicting"))


def cell_dates(cell: Column) -> Column:
    """SRC9: a date from text or from a spreadsheet's serial number between 20000 and 80000."""
    n = cell.try_cast("double")
    return F.when(n.between(20000, 80000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(n).cast("int"))).otherwise(F.try_to_date(cell, "yyyy-MM-dd"))


def date_convention(long: DataFrame) -> DataFrame:
    """SRC11: month_end, day_dd or mixed, for each variable."""
    g = long.groupBy("variable").agg(F.bool_and(F.col("date") == F.last_day("date")).alias("_end"), F.count_distinct(F.dayofmonth("date")).alias("_days"), F.min(F.dayofmonth("date")).alias("_day"))
    return g.select("variable", F.when(F.col("_end"), "month_end").when(F.col("_days") == 1, F.concat(F.lit("day_"), F.lpad(F.col("_day").cast("string"), 2, "0"))).otherwise("mixed").alias("convention"))


def align_month_end(long: DataFrame) -> DataFrame:
    """SRC12: dates at month ends; two dates of a firm in one month are an error when the rows are read."""
    w = by("variable", "stock", "month")
    m = long.withColumn("month", F.last_day("date")).withColumn("_n", F.count("*").over(w))
    bad = F.raise_error(F.concat(F.lit("two dates in one month: "), F.col("stock").cast("string")))
    return m.withColumn("month", F.when(F.col("_n") > 1, bad.cast("date")).otherwise(F.col("month"))).drop("_n", "date")


def latest_log(log: DataFrame) -> DataFrame:
    """SRC14: the latest row of each variable in an import log that is only ever added to."""
    return log.groupBy("variable").agg(F.max_by(F.struct("rows", "status"), "imported_at").alias("r"), F.max("imported_at").alias("imported_at")).select("variable", "r.rows", "r.status", "imported_at")


def needs_import(raw: DataFrame, panel: DataFrame) -> DataFrame:
    """SRC16: (variable, raw_at) of the variables whose raw files are newer than the panel, or that the panel lacks."""
    both = raw.select("variable", "raw_at").join(panel.select("variable", "panel_at"), "variable", "left")
    return both.where("panel_at is null or raw_at > panel_at").select("variable", "raw_at")


def inventory(registry: DataFrame, raw: DataFrame, panel: DataFrame, log: DataFrame, merged: DataFrame) -> DataFrame:
    """SRC15: every variable of registry, raw files, panel or log, with its state: missing (no panel), stale (raw files are newer) or
    current; after an incomplete import incomplete if there is a panel, blocked if there is none. registry: (variable, type), raw:
    (variable, n_files, raw_at), panel: (variable, panel_at), log: (variable, status, n_series, n_firms), its latest row each;
    merged: (name, variable) of the merged datasets. With the share of series that had data, and the datasets it is in."""
    within = merged.groupBy("variable").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("in_merged"))
    i = registry.withColumn("registered", F.lit(True)).join(raw, "variable", "full").join(panel, "variable", "full").join(log, "variable", "full").join(within, "variable", "left")
    state = F.when(F.col("panel_at").isNull(), "missing").when(F.col("raw_at") > F.col("panel_at"), "stale").otherwise("current")
    failed = F.coalesce(F.col("status") == "incomplete", F.lit(False))
    i = i.withColumn("state", F.when(failed & F.col("panel_at").isNull(), "blocked").when(failed, "incomplete").otherwise(state))
    i = i.withColumn("share_with_data", F.round(F.try_divide("n_firms", "n_series"), 3))
    return i.fillna(False, ["registered"]).fillna(0, ["n_files"]).fillna("", ["in_merged"]).fillna("timeseries", ["type"])


def value_types(cells: DataFrame) -> DataFrame:
    """SRC17: type of each variable's cells, by the majority of the known ones: date, number or text."""
    known = cells.where("trim(cell) <> '' and upper(trim(cell)) not in ('NA', '#NA', '#N/A', 'NAN')")
    g = known.groupBy("variable").agg(F.avg(F.try_to_date("cell", "yyyy-MM-dd").isNotNull().cast("int")).alias("d"), F.avg(F.col("cell").try_cast("double").isNotNull().cast("int")).alias("n"))
    return g.select("variable", F.when(F.col("d") >= 0.5, "date").when(F.col("n") >= 0.5, "number").otherwise("text").alias("type"))


def snapshot_changes(snaps: DataFrame) -> DataFrame:
    """SRC18: for each snapshot: firms, distinct values, and firms whose value differs from the snapshot before."""
    prev = F.lag("value").over(by("stock", order="as_of"))
    s = snaps.withColumn("_changed", F.coalesce(prev != F.col("value"), F.lit(False)))
    return s.groupBy("as_of").agg(F.count("*").alias("firms"), F.count_distinct("value").alias("kinds"), F.count_if("_changed").alias("changed"))


def static_as_of(snaps: DataFrame, at: str | None = None) -> DataFrame:
    """SRC19: each firm's latest value, on or before a date if one is given."""
    s = snaps if at is None else snaps.where(F.col("as_of") <= F.lit(at).cast("date"))
    return s.groupBy("stock").agg(F.max_by("value", "as_of").alias("value"), F.max("as_of").alias("as_of"))


def factor_lines(lines: DataFrame) -> DataFrame:
    """SRC22: rows (line, text) of a factor file: those that begin with a digit, up to the line with Annual; dates by day or
    month, percent to shares."""
    end = lines.where(F.col("text").contains("Annual")).agg(F.min("line").alias("_end"))
    t = lines.join(F.broadcast(end)).where(F.col("text").rlike(r"^\s*\d") & (F.col("line") < F.coalesce("_end", F.lit(2**62))))
    parts = F.split(F.trim("text"), r"[\s,]+")
    day = F.coalesce(F.try_to_date(F.get(parts, F.lit(0)), "yyyyMMdd"), F.last_day(F.try_to_date(F.concat(F.get(parts, F.lit(0)), F.lit("01")), "yyyyMMdd")))
    return t.select(day.alias("date"), (F.get(parts, F.lit(1)).try_cast("double") / 100).alias("market"), (F.get(parts, F.lit(2)).try_cast("double") / 100).alias("rf"))


def month_end_rates(rates: DataFrame) -> DataFrame:
    """SRC23: last known rate of each month; a point counts as missing."""
    r = rates.withColumn("_v", F.col("cell").try_cast("double")).where("_v is not null")
    return r.groupBy("series", F.last_day("date").alias("month")).agg(F.max_by("_v", "date").alias("rate"), F.count("*").alias("n"))


def index_returns(levels: DataFrame) -> DataFrame:
    """SRC24: returns over consecutive months of index levels; dates that nearly all stand on the first count for the month before."""
    first = levels.groupBy("series").agg((F.avg((F.dayofmonth("date") == 1).cast("int")) > 0.9).alias("_first"))
    m = levels.join(first, "series").withColumn("month", F.last_day(F.when(F.col("_first"), F.date_sub("date", 1)).otherwise(F.col("date"))))
    m = m.groupBy("series", "month").agg(F.max_by("level", "date").alias("level"))
    w = by("series", order="month")
    return m.withColumn("ret", F.when(months_between(F.col("month"), F.lag("month").over(w)) == 1, F.try_divide("level", F.lag("level").over(w)) - 1))


def date_profile(rows: DataFrame) -> DataFrame:
    """SRC25: dates of each series: count, first, last, share at month ends and on the first, median gap in days."""
    d = rows.select("series", "date").distinct()
    d = d.withColumn("_gap", F.date_diff("date", F.lag("date").over(by("series", order="date"))))
    return d.groupBy("series").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"), F.avg((F.col("date") == F.last_day("date")).cast("int")).alias("month_end"), F.avg((F.dayofmonth("date") == 1).cast("int")).alias("day_one"), F.median("_gap").alias("median_gap"))


def readable_names(df: DataFrame, names: dict[str, str], suffix: str = "_prev") -> DataFrame:
    """SNK2: columns renamed to readable names, also with a suffix; clashes are an error."""
    full = names | {f"{k}{suffix}": f"{v}{suffix}" for k, v in names.items()}
    out = [full.get(c, c) for c in df.columns]
    twice = {c for c in out if out.count(c) > 1}
    if twice:
        raise ValueError(f"names clash: {sorted(twice)}")
    return df.toDF(*out)


def output_metrics(df: DataFrame, *keys: str) -> DataFrame:
    """SNK1: rows, firms, first and last month of an output, beside it as a one-row frame."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct("stock").alias("stocks"), F.min("month").alias("first"), F.max("month").alias("last"), *[F.count(k).alias(f"n_{k}") for k in keys])


def stack_files(spark, paths: list[str], pattern: str) -> DataFrame:
    """SRC6: rows of all files under one schema (the union of theirs), with the part of the path that the pattern finds as `folder`."""
    d = spark.read.option("mergeSchema", True).parquet(*paths)
    return d.withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def registry(lines: DataFrame, schema: str) -> DataFrame:
    """SRC21: rows of a registry, relations or pattern file given as text lines: comments (#) and empty lines go, cells that do
    not fit the schema are null."""
    t = lines.where(~F.ltrim("text").startswith("#") & (F.trim("text") != ""))
    return t.select(F.from_csv("text", schema, {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("_r")).select("_r.*")


def survivor_statics(statics: DataFrame, panel: DataFrame) -> DataFrame:
    """SRC27: statics of the stocks that have rows left in the panel."""
    return statics.join(panel.select("stock").distinct(), "stock", "left_semi")


def write_by_country(panel: DataFrame, path: str) -> None:
    """SRC27: the panel as Parquet, one folder for each country; a hot country is spread over tasks by its stocks."""
    panel.repartition("country", F.pmod(F.xxhash64("stock"), F.lit(64))).write.mode("overwrite").partitionBy("country").parquet(path)
