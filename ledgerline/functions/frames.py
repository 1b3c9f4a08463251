"""Window helpers: deterministic first rows, islands of equal values, guarded rolling frames, as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by(*keys: str, order: str | Column | list | None = None) -> WindowSpec:
    w = Window.partitionBy(*keys)
    return w if order is None else w.orderBy(*(order if isinstance(order, list) else [order]))


def first_rows(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key, the first in an explicit order."""
    return df.withColumn("_rn", F.row_number().over(by(*keys, order=order))).where("_rn = 1").drop("_rn")


def island(changed: Column, w: WindowSpec) -> Column:
    """Number of the run that a row is in; a run begins where `changed` is true."""
    return F.sum(F.coalesce(changed, F.lit(True)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))


def full_frame(value: Column, agg, w: WindowSpec, rows: int, end: int = 0) -> Column:
    """`agg` over the `rows` rows that end `end` rows from here, null unless all of them have a value."""
    frame = w.rowsBetween(end - rows + 1, end)
    return F.when(F.count(value).over(frame) == rows, agg(value).over(frame))


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time, as one struct column `matched`.

    The union of both sides is put in order once for each key, so the work is linear. The struct is taken whole:
    a right row with null items still hides older ones. Right rows are unique by (key, time).
    """
    l = left.withColumn("_time", F.col(left_time)).withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.select(F.struct(right_time, *values).alias("v")).schema["v"].dataType))
    r = right.select(F.col(key), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), F.struct(right_time, *values).alias("_v"))
    both = l.unionByName(r, allowMissingColumns=True)
    w = by(key, order=["_time", "_side"]).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("matched", F.last("_v", ignorenulls=True).over(w)).where("_side = 1").drop("_time", "_side", "_v")


def spread_rank(df: DataFrame, value: str, name: str, *keys: str) -> DataFrame:
    """Rank in a group of any size, with ties at their mean, as a new column; a value that is not null in every row.

    Rows are first counted by value. Distinct values are put in order within bands of like size (a monotone function of the
    value alone), and the rows of the bands before are added, so that no task orders a whole group."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_band", F.floor(16 * F.signum(value) * F.log1p(F.abs(value))))
    bands = counts.groupBy(*keys, "_band").agg(F.sum("_n").alias("_t"))
    bands = bands.select(*keys, "_band", (F.sum("_t").over(by(*keys, order="_band")) - F.col("_t")).alias("_before"))
    inside = F.sum("_n").over(by(*keys, "_band", order=value)) - F.col("_n")
    ranks = counts.withColumn("_inside", inside).join(bands, [*keys, "_band"])
    ranks = ranks.select(*keys, value, (F.col("_before") + F.col("_inside") + (F.col("_n") + 1) / 2).alias(name))
    return df.join(ranks, [*keys, value])


def quantile_bin(order: list, bins: int, *keys: str) -> Column:
    """Bin 1 to `bins` of a row by its place in the group, cut where a quantile cut of the ranks cuts."""
    r, n = F.row_number().over(by(*keys, order=order)), F.count(F.lit(1)).over(by(*keys))
    return F.greatest(F.lit(1), F.floor(((r - 1) * bins + (n - 2)) / F.greatest(n - 1, F.lit(1)))).cast("int")


def correlation(a: str, b: str) -> Column:
    """Correlation of two columns as an aggregate; null where one does not vary (the built-in one stops there)."""
    return F.try_divide(F.covar_samp(a, b), F.nullif(F.stddev_samp(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_samp(F.when(F.col(a).isNotNull(), F.col(b))), F.lit(0.0)))
