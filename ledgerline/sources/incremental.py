"""Imports that read only what changed, and writers that count in the pass that writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.sources.imports import needs_import


def raw_files(spark: SparkSession, pattern: str, name: str) -> DataFrame:
    """(variable, path, modified) of the files that a glob pattern finds; `name` is the pattern of the variable in a path. File contents
    are not read."""
    f = spark.read.format("binaryFile").load(pattern).select("path", F.col("modificationTime").alias("modified"))
    return f.withColumn("variable", F.regexp_extract("path", name, 1)).where("variable <> ''")


def write_observed(df: DataFrame, path: str, keys: list[str] | None = None, **metrics) -> dict:
    """SNK1: write a table and return its figures (aggregates by name, and rows), taken in the same pass: no second scan. With keys the
    table lies in folders, and only those that df has are replaced."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]).write.mode("overwrite")
    if keys:
        out = out.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    out.parquet(path)
    return seen.get


def import_changed(spark: SparkSession, pattern: str, name: str, schema: StructType | str, panel: str, log: str) -> list[str]:
    """SRC14, SRC16: import the CSV files of all variables that are new, or whose newest file is newer than their last import; returns
    their names. The panel's folders of these variables are replaced, and the log gets a row for each: (variable, raw_at,
    rows, imported_at). The log is only added to, after the panel is written: a run that fails is done again, a run without
    changed files reads and writes nothing. File lists are as long as the folders, so they are held by the driver."""
    files = raw_files(spark, pattern, name)
    logged = _log(spark, log)
    newest = files.groupBy("variable").agg(F.max("modified").alias("raw_at"))
    done = logged.groupBy("variable").agg(F.max("raw_at").alias("panel_at"))
    due = needs_import(newest, done)
    todo = {r["variable"]: r["raw_at"] for r in due.collect()}
    if not todo:
        return []
    paths = [r["path"] for r in files.join(due, "variable", "left_semi").select("path").collect()]
    rows = spark.read.schema(schema).option("header", True).csv(paths).withColumn("variable", F.regexp_extract(F.col("_metadata.file_path"), name, 1))
    counted = write_observed(rows, panel, ["variable"], **{f"n{k}": F.count_if(F.col("variable") == v) for k, v in enumerate(sorted(todo))})
    added = [(v, todo[v], counted[f"n{k}"]) for k, v in enumerate(sorted(todo))]
    spark.createDataFrame(added, "variable string, raw_at timestamp, rows long").withColumn("imported_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(log)
    return sorted(todo)


def _log(spark: SparkSession, path: str) -> DataFrame:
    schema = "variable string, raw_at timestamp, rows long, imported_at timestamp"
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_report(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """EC16: write every table of a report in a folder of its own; returns (table, rows), counted in the passes that write."""
    counts = [(name, write_observed(d, f"{path}/{name}")["rows"]) for name, d in tables.items()]
    return next(iter(tables.values())).sparkSession.createDataFrame(counts, "table string, rows long")
