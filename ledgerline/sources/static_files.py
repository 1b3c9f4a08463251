"""Static vendor files: rows of id and value cells read as text, dated by their folder, with reports by file and by snapshot.

Cells have (file, as_of, line, id, numeric, cell): `numeric` says that the id came as a number, so that leading zeros may be lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.frames import by
from ledgerline.operators.listings import MISSING

# Fixed value: cells that stand for an error of the vendor's.
ERROR = r"^\s*(\$\$ER|#ERROR)"


def read_cells(spark: SparkSession, paths: list[str], id_column: str, value_column: str) -> DataFrame:
    """Cells of delimited files with a header, all as text: as_of is the folder's date (yyyy-mm-dd), else the file's time of change."""
    d = spark.read.option("header", True).csv(paths)
    path, changed = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    dated = F.try_to_date(F.regexp_extract(path, r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1), "yyyy-MM-dd")
    return d.select(F.regexp_extract(path, r"([^/]*)$", 1).alias("file"), F.coalesce(dated, changed.cast("date")).alias("as_of"), F.monotonically_increasing_id().alias("line"), F.col(id_column).alias("id"), F.col(id_column).rlike(r"^\d+(\.0)?$").alias("numeric"), F.col(value_column).alias("cell"))


def clean_id(raw: Column, numeric: Column) -> Column:
    """The id without blanks, numeric ones padded to six digits; null if blank."""
    plain = F.trim(raw)
    digits = F.regexp_replace(plain, r"\.0$", "")
    return F.nullif(F.when(numeric & (F.length(digits) < 6), F.lpad(digits, 6, "0")).when(numeric, digits).otherwise(plain), F.lit(""))


def typed_cells(cells: DataFrame) -> DataFrame:
    """Each cell with its id, its state (missing, error, coerced, value) and the type of its file's values: date, number or text, by the
    majority; `value` is the text of a cell of that type."""
    text = F.trim("cell")
    missing = F.col("cell").isNull() | F.upper(text).isin(*MISSING)
    error = F.col("cell").rlike(ERROR)
    c = cells.withColumns({"stock": clean_id(F.col("id"), F.col("numeric")), "_known": ~missing & ~error, "_missing": missing, "_error": ~missing & error})
    c = c.withColumns({"_date": F.col("_known") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), "_number": F.col("_known") & text.try_cast("double").isNotNull()})
    kinds = c.groupBy("file", "as_of").agg(F.count_if("_known").alias("_n"), F.count_if("_date").alias("_d"), F.count_if("_number").alias("_m"))
    kind = F.when(F.col("_n") == 0, "").when(2 * F.col("_d") >= F.col("_n"), "date").when(2 * F.col("_m") >= F.col("_n"), "number").otherwise("text")
    c = c.join(kinds.select("file", "as_of", kind.alias("type")), ["file", "as_of"])
    fits = F.col("_known") & F.when(F.col("type") == "date", F.col("_date")).when(F.col("type") == "number", F.col("_number")).otherwise(F.lit(True))
    state = F.when(F.col("_missing"), "missing").when(F.col("_error"), "error").when(~fits, "coerced").otherwise("value")
    return c.select("file", "as_of", "line", "id", "numeric", "stock", "cell", "type", state.alias("state"), F.when(fits, text).alias("value"))


def file_reports(typed: DataFrame) -> DataFrame:
    """SRC17: one row for each file: status, firms asked for and with data, missing, error and coerced cells with five examples of
    errors, padded, blank and duplicate ids, type."""
    known = F.col("stock").isNotNull() & F.col("value").isNotNull()
    padded = F.col("numeric") & (F.length(F.regexp_replace(F.trim("id"), r"\.0$", "")) < 6)
    r = typed.groupBy("file", "as_of").agg(
        F.count("stock").alias("series"), F.count_distinct(F.when(known, F.col("stock"))).alias("firms"), F.count_if(F.col("state") == "missing").alias("missing"), F.count_if(F.col("state") == "error").alias("errors"),
        F.array_join(F.slice(F.array_sort(F.collect_set(F.when(F.col("state") == "error", F.col("cell")))), 1, 5), " | ").alias("examples"), F.count_if(F.col("state") == "coerced").alias("coerced"),
        F.count_if(padded).alias("padded"), F.count_if(F.col("stock").isNull()).alias("blank"), F.count_if(known).alias("_known"), F.first("type").alias("type"),
    )
    status = F.when(F.col("firms") == 0, "no_data").otherwise("ok")
    return r.withColumn("duplicates", F.col("_known") - F.col("firms")).withColumn("status", status).drop("_known")


def snapshots(typed: DataFrame) -> DataFrame:
    """The panel (stock, as_of, value): of ids that a snapshot repeats the first in order of file and line; and `repeats`, how many
    further ones there were."""
    w = by("stock", "as_of", order=["file", "line"])
    k = typed.where("stock is not null and value is not null").withColumns({"_r": F.row_number().over(w), "repeats": F.count("*").over(by("stock", "as_of")) - 1})
    return k.where("_r = 1").select("stock", "as_of", "value", "repeats")


def snapshot_report(panel: DataFrame) -> DataFrame:
    """SRC18: one row for each snapshot: firms, distinct values, repeated ids, and of the firms that the snapshot before has too, those
    whose value differs."""
    order = panel.select("as_of").distinct().withColumn("_one", F.lit(1)).withColumn("_before", F.lag("as_of").over(by("_one", order="as_of"))).drop("_one")
    was = panel.select("stock", F.col("as_of").alias("_before"), F.col("value").alias("_was"))
    j = panel.join(order, "as_of").join(was, ["stock", "_before"], "left")
    return j.groupBy("as_of").agg(F.count("*").alias("firms"), F.count_distinct("value").alias("kinds"), F.sum("repeats").alias("repeats"), F.count("_was").alias("compared"), F.count_if(F.col("_was") != F.col("value")).alias("changed"))


def value_distribution(panel: DataFrame, dates: bool = False) -> DataFrame:
    """SRC18: firms of each snapshot with each value; of dates with each month (a fiscal year end)."""
    value = F.month(F.to_date("value")).cast("string") if dates else F.col("value")
    return panel.groupBy("as_of", value.alias("value")).agg(F.count("*").alias("firms"))
