"""QC19: relations between variables on one cross-section: identities, bounds, ranges and comparisons, as a table of rules."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.frames import by, correlation, spread_rank


class Rule(NamedTuple):
    """name, kind (identity, le, range, compare), both sides and the condition as SQL expressions of columns; empty: none."""

    name: str
    kind: str
    lhs: str
    rhs: str = ""
    tolerance: float | None = None
    lower: float | None = None
    upper: float | None = None
    condition: str = ""


# The rules of the firm variables, by the vendor's item codes.
FIRM_RULES = (
    Rule("total_debt_identity", "identity", "WC03255", "WC03051 + WC03251", 0.01),
    Rule("debt_le_assets", "le", "WC03255", "WC02999", 0.0),
    Rule("cash_le_assets", "le", "WC02003", "WC02999", 0.0),
    Rule("capex_le_assets", "le", "WC04601", "WC02999", 0.0),
    Rule("st_debt_le_total_debt", "le", "WC03051", "WC03255", 0.001),
    Rule("lt_debt_le_total_debt", "le", "WC03251", "WC03255", 0.001),
    Rule("ebitda_margin", "range", "WC18198 / WC01001", lower=-2.0, upper=1.0, condition="WC01001 >= 10000"),
    Rule("debt_to_equity", "compare", "WC08231", "100 * WC03255 / WC03501"),
    Rule("roe", "compare", "WC08301", "100 * WC01751 / WC03501"),
    Rule("roa", "compare", "WC08326", "100 * WC01751 / WC02999"),
    Rule("pe", "compare", "PE", "Close / EPS"),
    Rule("mtbv", "compare", "MTBV", "1000 * MarketCAP / WC03501"),
    Rule("mv_to_assets", "range", "1000 * MarketCAP / WC02999", lower=0.001, upper=1000.0),
)
_WORDS = {"abs", "log", "log10", "exp", "and", "or", "not"}


def names(*expressions: str) -> list[str]:
    """Columns that the expressions name."""
    return sorted({n for e in expressions for n in re.findall(r"[A-Za-z_]\w*", e)} - _WORDS)


def _safe(expression: str):
    """The expression as a double: a divisor (a name, a number or one pair of brackets) of zero gives null, as do results that are not finite."""
    value = F.expr(re.sub(r"/\s*([A-Za-z_]\w*|[\d.]+|\([^()]*\))", r"/ nullif(\1, 0)", expression)).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def missing(df: DataFrame, rule: Rule) -> list[str]:
    return [n for n in names(rule.lhs, rule.rhs, rule.condition) if n not in df.columns]


def evaluated(df: DataFrame, rules: tuple[Rule, ...], keys: tuple[str, ...] = ("stock", "month")) -> DataFrame:
    """(keys, relation, lhs, rhs, off): one row for each row of df and each rule that can be read and applies; off: violated."""
    cells = []
    for r in rules:
        if missing(df, r):
            continue
        one, two = _safe(r.lhs), _safe(r.rhs) if r.rhs else F.lit(None).cast("double")
        applies = one.isNotNull() & (two.isNotNull() if r.rhs else F.lit(True)) & (F.coalesce(F.expr(r.condition), F.lit(False)) if r.condition else F.lit(True))
        tolerance = r.tolerance or 0.0
        off = {
            "identity": F.coalesce(F.abs(one / F.nullif(two, F.lit(0.0)) - 1) > tolerance, F.lit(False)) | ((two == 0) & (one != 0)),
            "le": one > two * (1 + tolerance) + 1e-12,
            "range": F.coalesce(one < r.lower, F.lit(False)) | F.coalesce(one > r.upper, F.lit(False)),
        }.get(r.kind, F.lit(None).cast("boolean"))
        cells.append(F.when(applies, F.struct(F.lit(r.name).alias("relation"), one.alias("lhs"), two.alias("rhs"), off.alias("off"))))
    empty = F.array().cast("array<struct<relation:string,lhs:double,rhs:double,off:boolean>>")
    return df.select(*keys, F.explode(F.array_compact(F.array(*cells)) if cells else empty).alias("c")).select(*keys, "c.*")


def summary(df: DataFrame, cells: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row for each rule: status (ok, no overlapping observations, or skipped with the missing names), firm-years, share of violations,
    median of lhs / rhs, share of these within 5 %, share of 0 beside 0, rank correlation."""
    spark = df.sparkSession
    given = [(r.name, r.kind, r.lhs, r.rhs, r.condition, ", ".join(missing(df, r))) for r in rules]
    table = spark.createDataFrame(given, "relation string, kind string, lhs string, rhs string, condition string, missing string")
    two = cells.where("rhs is not null")
    ranks = spread_rank(spread_rank(two, "lhs", "_a", "relation"), "rhs", "_b", "relation").groupBy("relation").agg(correlation("_a", "_b").alias("_r"), F.count("*").alias("_n"))
    ratio = F.try_divide("lhs", "rhs")
    figures = cells.groupBy("relation").agg(
        F.count("*").alias("n"), F.avg(F.col("off").cast("int")).alias("violations"), F.median(ratio).alias("median_ratio"), F.avg((F.abs(ratio - 1) <= 0.05).cast("int")).alias("_within"),
        F.avg(F.when(F.col("rhs").isNotNull(), ((F.col("lhs") == 0) & (F.col("rhs") == 0)).cast("int"))).alias("both_zero"),
    )
    out = table.join(figures, "relation", "left").join(ranks, "relation", "left").fillna(0, ["n"])
    status = F.when(F.col("missing") != "", F.concat(F.lit("skipped (missing "), "missing", F.lit(")"))).when(F.col("n") == 0, "no overlapping observations").otherwise("ok")
    within = F.when(F.col("kind").isin("identity", "compare"), F.col("_within"))
    return out.select("relation", "kind", "lhs", "rhs", "condition", status.alias("status"), "n", "violations", "median_ratio", within.alias("within"), "both_zero", F.when(F.col("_n") > 2, F.col("_r")).alias("spearman"))


def by_year(cells: DataFrame, date: str = "month") -> DataFrame:
    """Share of violations of each rule and year; comparisons have none."""
    return cells.where("off is not null").groupBy("relation", F.year(date).alias("year")).agg(F.avg(F.col("off").cast("int")).alias("violations"), F.count("*").alias("n"))


def examples(cells: DataFrame, keys: tuple[str, ...] = ("stock", "month"), most: int = 50) -> DataFrame:
    """The first `most` violations of each rule in the order of the keys; first in parts of each rule, so that no task meets all."""
    bad = cells.where("off").withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(32)))
    for groups in (("relation", "_part"), ("relation",)):
        bad = bad.withColumn("rank", F.row_number().over(by(*groups, order=list(keys)))).where(F.col("rank") <= most)
    return bad.drop("_part", "off")
