"""Queries of the whole battery: error counts, relations, summary and flags, on a panel with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import checks as q
from ledgerline.operators import relations as rel
from ledgerline.plans.check_queries import _CV, _r, panel, part_universe
from ledgerline.plans.pit_queries import WIDE_SQL, annual_wide
from ledgerline.plans.registry import query
from ledgerline.plans.universe_queries import universe
from ledgerline.sources.proxy import daily_panel, delistings, statics

NONNEG = ["assets", "equity", "sales"]


def faulty(spark, sf_dir):
    """Some firms' items of one year in another unit, one item of some firms negative for a year or always zero."""
    thousand = F.when((F.col("stock") % 10 == 3) & (F.year("month") == 1995), 1000.0).otherwise(1.0)
    sign = F.when((F.col("variable") == "sales") & (F.col("stock") % 9 == 4) & (F.year("month") == 1996), -1.0).when((F.col("variable") == "equity") & (F.col("stock") % 8 == 5), 0.0).otherwise(1.0)
    return panel(spark, sf_dir).withColumn("value", F.col("value") * thousand * sign)


def dated_universe(spark, sf_dir):
    return part_universe(spark, sf_dir).join(delistings(daily_panel(spark, sf_dir)), "stock")


FAULTY_SQL = WIDE_SQL + f""", lng AS (SELECT stock, month, unnest(['sales', 'assets', 'equity']) AS variable, unnest([sales, assets, equity]) AS value FROM wide),
 p AS (SELECT variable, stock, month, value * CASE WHEN stock % 10 = 3 AND year(month) = 1995 THEN 1000.0 ELSE 1.0 END * CASE WHEN variable = 'sales' AND stock % 9 = 4 AND year(month) = 1996 THEN -1.0 WHEN variable = 'equity' AND stock % 8 = 5 THEN 0.0 ELSE 1.0 END AS value FROM lng WHERE value IS NOT NULL),
 un AS (SELECT uni.* EXCLUDE (last_date), delisting_date FROM uni JOIN delistings USING (stock) WHERE stock % 4 > 0 OR year(month) BETWEEN 1994 AND 1996), pu AS (SELECT p.* FROM p SEMI JOIN un USING (stock, month)),
 ch AS (SELECT * FROM (SELECT *, lag(value) OVER (PARTITION BY variable, stock ORDER BY month) AS prev FROM pu) WHERE value <> prev),
 e AS (SELECT *, log10(value / prev) AS step FROM ch WHERE prev > 0 AND value > 0),
 e1 AS (SELECT *, coalesce(abs(step) >= 0.9 AND abs(lead(step) OVER w + step) <= 0.3 AND date_diff('month', month, lead(month) OVER w) <= 24, false) AS reversed FROM e WINDOW w AS (PARTITION BY variable, stock ORDER BY month)),
 j AS (SELECT * FROM (SELECT *, coalesce(lag(reversed) OVER (PARTITION BY variable, stock ORDER BY month), false) AS undoes FROM e1) WHERE (abs(step) >= 2.5 OR reversed) AND NOT undoes),
 cand AS (SELECT stock, month, list(DISTINCT variable) AS vs FROM j GROUP BY 1, 2 HAVING count(DISTINCT variable) >= 3 AND max(step) - min(step) <= 0.15 AND least(abs(median(abs(step)) - 3), abs(median(abs(step)) - 6)) <= 0.2),
 fm AS (SELECT variable, count(DISTINCT stock) AS firms FROM pu GROUP BY 1), er AS (SELECT v AS variable, count(*) AS errors FROM (SELECT unnest(vs) AS v FROM cand) GROUP BY 1),
 ec AS (SELECT variable, firms, coalesce(errors, 0) AS errors, 1000 * coalesce(errors, 0) / greatest(firms, 1) AS per_thousand FROM fm LEFT JOIN er USING (variable))"""


@query("qc15_error_counts", f"{FAULTY_SQL} SELECT variable, firms, errors, round(per_thousand, 7) AS per_thousand FROM ec")
def qc15(spark, sf_dir):
    """Unit errors of each variable for a thousand firms of the universe."""
    pu = q.with_universe(faulty(spark, sf_dir), dated_universe(spark, sf_dir)).where("in_universe")
    return _r(q.error_counts(q.unit_error_candidates(q.unit_jumps(pu)), pu), 7, "per_thousand")


_BATTERY = f"""{FAULTY_SQL}, {_CV}, cy AS (SELECT variable, year(month) AS year, avg(n_value / n) AS ew, avg(cap_value / nullif(cap, 0)) AS vw FROM cv GROUP BY 1, 2), fin AS (SELECT max(month) AS fin, year(max(month)) - CAST(month(max(month)) < 12 AS INT) AS ly FROM un),
 f AS (SELECT variable, stock, count(*) AS n, date_diff('month', min(month), max(month)) + 1 AS span FROM p GROUP BY 1, 2), hi AS (SELECT variable, count(*) AS n_firms, median(n) AS median_history_months, avg(CAST(span > n AS INT)) AS share_firms_with_gaps, CAST(sum(span - n) AS DOUBLE) / sum(span) AS share_gap_months FROM f GROUP BY 1),
 sp AS (SELECT variable, min(month) AS first_date, max(month) AS last_date, count(*) AS rows FROM p GROUP BY 1), iu AS (SELECT DISTINCT variable, stock FROM un JOIN sp ON month BETWEEN first_date AND last_date),
 ma AS (SELECT variable, count(m + u) / greatest(count(u), 1) AS share_universe_firms_ever_covered, count(m + u) / greatest(count(m), 1) AS share_variable_firms_in_universe FROM (SELECT variable, f.stock AS m, iu.stock AS u FROM f FULL JOIN iu USING (variable, stock)) GROUP BY 1),
 co AS (SELECT variable, min(year) FILTER (vw >= 0.5) AS first_year_vw_cov_50, any_value(ly) - 1 AS coverage_ref_year, max(ew) FILTER (year = ly - 1) AS ew_coverage_ref, max(vw) FILTER (year = ly - 1) AS vw_coverage_ref, max(ew) FILTER (year = ly) AS ew_coverage_last_year, max(vw) FILTER (year = ly) AS vw_coverage_last_year FROM cy, fin GROUP BY 1),
 ou AS (SELECT variable, sum(n_outside) AS outside FROM cv GROUP BY 1),
 uy AS (SELECT variable, stock, year(month) AS year, count(*) AS n FROM pu GROUP BY 1, 2, 3 HAVING count(*) >= 12), uc AS (SELECT variable, stock, year(month) AS year, count(*) AS k FROM ch GROUP BY 1, 2, 3), uj AS (SELECT variable, year, median(coalesce(k, 0)) AS md, avg(CAST(coalesce(k, 0) = 0 AS INT)) AS none FROM uy LEFT JOIN uc USING (variable, stock, year) GROUP BY 1, 2),
 up AS (SELECT variable, median(md) AS median_changes_per_year, avg(none) AS share_firm_years_no_change FROM uj GROUP BY 1),
 lg AS (SELECT variable, CAST((month(month) - (stock % 12 + 1) + 12) % 12 AS INT) AS lag, count(*) AS n FROM ch GROUP BY 1, 2), lm AS (SELECT variable, lag AS modal_lag_months, n / total AS share_at_modal_lag FROM (SELECT *, sum(n) OVER (PARTITION BY variable) AS total, row_number() OVER (PARTITION BY variable ORDER BY n DESC, lag) AS r FROM lg) WHERE r = 1),
 lf AS (SELECT stock, min(month) AS first_price, max(month) AS last_price, any_value(delisting_date) AS delisting_date FROM un GROUP BY 1),
 sr AS (SELECT *, sum(CASE WHEN prev IS NULL OR value <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY variable, stock ORDER BY month ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(value) OVER (PARTITION BY variable, stock ORDER BY month) AS prev FROM p)), ps AS (SELECT *, row_number() OVER (PARTITION BY variable, stock, run ORDER BY month) > 11 AS long FROM sr),
 sx AS (SELECT ps.variable, ps.stock, ps.month, value, long, un.stock IS NOT NULL AS alive, lf.* EXCLUDE (stock), fin FROM ps CROSS JOIN fin LEFT JOIN un ON un.stock = ps.stock AND un.month = ps.month LEFT JOIN lf ON lf.stock = ps.stock),
 sf AS (SELECT variable, stock, count(*) AS n, count(last_price) AS m, count(*) FILTER (month > last_price) AS aft, count(*) FILTER (month < first_price) AS bef, count(*) FILTER (month > last_day(delisting_date)) AS del, count(*) FILTER (long AND value <> 0) AS st, count(*) FILTER (alive) AS al,
  count(*) FILTER (long AND value <> 0 AND alive) AS sa, count(*) FILTER (long AND value = 0 AND alive) AS za, bool_or(CASE WHEN last_price < fin THEN date_diff('month', last_price, month) > 12 END) AS padded FROM sx GROUP BY 1, 2),
 st AS (SELECT variable, avg(CAST(padded AS INT)) AS share_dead_firms_padded, CAST(sum(aft) AS DOUBLE) / nullif(sum(m), 0) AS share_after_last_price, CAST(sum(del) AS DOUBLE) / nullif(sum(m), 0) AS share_after_delisting, CAST(sum(bef) AS DOUBLE) / nullif(sum(m), 0) AS share_before_first_price,
  CAST(sum(st) AS DOUBLE) / sum(n) AS share_stale, CAST(sum(sa) AS DOUBLE) / greatest(sum(al), 1) AS share_stale_while_trading, CAST(sum(za) AS DOUBLE) / greatest(sum(al), 1) AS share_zero_runs_while_trading, avg(CAST(sa > 0 AS INT)) AS share_firms_with_stale_run FROM sf GROUP BY 1),
 fyr AS (SELECT variable, stock, year(month) AS year, arg_max(value, month) AS value FROM pu GROUP BY 1, 2, 3), fx AS (SELECT *, CASE WHEN value > 0 THEN log10(value) END AS x FROM fyr), md AS (SELECT *, median(x) OVER (PARTITION BY variable, year) AS m FROM fx), ad AS (SELECT variable, year, median(abs(x - m)) * 1.4826 AS d FROM md GROUP BY 1, 2),
 im AS (SELECT variable, avg(CAST(value = 0 AS INT)) AS share_zero, avg(CAST(value < 0 AS INT)) AS share_negative, avg(CAST(value < 0 AS INT)) AS share_sign_violations, avg(CAST(coalesce(d > 1e-9 * (1 + abs(m)) AND abs((x - m) / d) > 8, false) AS INT)) AS share_extreme FROM md JOIN ad USING (variable, year) GROUP BY 1),
 jn AS (SELECT variable, count(*) AS n_large_jumps FROM j GROUP BY 1),
 su AS (SELECT variable, first_date, last_date, n_firms, median_history_months, share_firms_with_gaps, share_gap_months, coalesce(firms, 0) AS n_firms_in_universe, share_universe_firms_ever_covered, share_variable_firms_in_universe, first_year_vw_cov_50, coverage_ref_year, ew_coverage_ref, vw_coverage_ref, ew_coverage_last_year, vw_coverage_last_year,
  median_changes_per_year, share_firm_years_no_change, modal_lag_months, share_at_modal_lag, share_dead_firms_padded, share_after_last_price, share_after_delisting, share_before_first_price, share_stale, share_stale_while_trading, share_zero_runs_while_trading, share_firms_with_stale_run, share_zero, share_negative, share_sign_violations, share_extreme,
  coalesce(n_large_jumps, 0) AS n_large_jumps, coalesce(errors, 0) AS n_unit_errors, coalesce(per_thousand, 0) AS unit_errors_per_1000_firms, outside / rows AS outside_universe_share
  FROM sp LEFT JOIN hi USING (variable) LEFT JOIN ma USING (variable) LEFT JOIN co USING (variable) LEFT JOIN ou USING (variable) LEFT JOIN up USING (variable) LEFT JOIN lm USING (variable) LEFT JOIN st USING (variable) LEFT JOIN im USING (variable) LEFT JOIN jn USING (variable) LEFT JOIN ec USING (variable)),
 fl AS (SELECT *, concat_ws('; ', CASE WHEN vw_coverage_ref < 0.80 THEN 'VW coverage (ref. year)' END, CASE WHEN share_after_last_price > 0.02 THEN 'values after last price' END, CASE WHEN share_dead_firms_padded > 0.10 THEN 'padding after delisting' END, CASE WHEN share_stale_while_trading > 0.05 THEN 'stale while trading' END,
  CASE WHEN share_sign_violations > 0.001 THEN 'sign violations' END, CASE WHEN share_extreme > 0.005 THEN 'extreme values' END, CASE WHEN unit_errors_per_1000_firms > 1.0 THEN 'unit errors' END, CASE WHEN outside_universe_share > 0.50 THEN 'outside universe' END) AS flags FROM su)"""
_SHARES = [
    "share_firms_with_gaps", "share_gap_months", "share_universe_firms_ever_covered", "share_variable_firms_in_universe", "ew_coverage_ref", "vw_coverage_ref", "ew_coverage_last_year", "vw_coverage_last_year", "share_firm_years_no_change", "share_at_modal_lag", "share_dead_firms_padded",
    "share_after_last_price", "share_after_delisting", "share_before_first_price", "share_stale", "share_stale_while_trading", "share_zero_runs_while_trading", "share_firms_with_stale_run", "share_zero", "share_negative", "share_sign_violations", "share_extreme", "unit_errors_per_1000_firms", "outside_universe_share",
]
_WHOLE = ["variable", "first_date", "last_date", "n_firms", "median_history_months", "n_firms_in_universe", "first_year_vw_cov_50", "coverage_ref_year", "median_changes_per_year", "modal_lag_months", "n_large_jumps", "n_unit_errors"]


def _battery(spark, sf_dir):
    fye = statics(spark, sf_dir).select("stock", (F.col("stock") % 12 + 1).alias("fye_month"))
    return q.battery(faulty(spark, sf_dir), dated_universe(spark, sf_dir), fye, NONNEG, run=11)


@query("qc21_battery", f"{_BATTERY} SELECT {', '.join(_WHOLE)}, {', '.join(f'round({c}, 8) AS {c}' for c in _SHARES)} FROM fl")
def qc21(spark, sf_dir):
    """One summary row for each variable, all of the battery's figures in one job."""
    return _r(_battery(spark, sf_dir), 8, *_SHARES).select(*_WHOLE, *_SHARES)


@query("qc22_flags", f"{_BATTERY} SELECT variable, flags, CASE WHEN flags = '' THEN 0 ELSE len(string_split(flags, '; ')) END AS n_flags FROM fl")
def qc22(spark, sf_dir):
    """The flags that the summary raises by the battery's limits."""
    return _battery(spark, sf_dir).select("variable", "flags", F.col("n_flags").cast("long").alias("n_flags"))


# The December panel by item codes: (code, SQL of the proxy's columns), the same text for both engines.
ITEMS = [
    ("WC02999", "assets"), ("WC03051", "assets * 0.1"), ("WC03251", "CASE WHEN stock % 6 = 1 THEN 0.0 ELSE sales * 0.2 END"), ("WC03255", "CASE WHEN stock % 7 = 2 THEN 0.0 WHEN stock % 5 = 4 THEN assets * 1.2 ELSE assets * 0.1 + sales * 0.2 END"), ("WC02003", "sales * 1.04"),
    ("WC18198", "CASE WHEN stock % 11 = 3 THEN sales * 3 ELSE sales * 0.1 END"), ("WC01001", "sales * (stock % 3)"), ("WC08231", "100 * sales / assets"), ("WC03501", "CASE WHEN stock % 13 = 6 THEN 0.0 ELSE equity END"), ("WC08301", "CASE WHEN stock % 2 = 0 THEN 250 * sales / assets END"), ("WC01751", "sales * 0.05"),
    ("PE", "CAST(stock + month(month) + year(month) % 7 AS DOUBLE)"), ("EPS", "CASE WHEN stock % 4 = 1 THEN 0.0 ELSE 0.5 + stock % 9 END"), ("Close", "close"), ("MTBV", "market_cap / assets"), ("MarketCAP", "market_cap / 1000"),
]


def december(spark, sf_dir):
    """Rows of the universe's Decembers with the items; capital expenditure and return on assets have no column."""
    w = annual_wide(spark, sf_dir).where(F.month("month") == 12)
    d = universe(spark, sf_dir).where(F.month("month") == 12).join(w, ["stock", "month"])
    return d.select("stock", "month", *[F.expr(e).cast("double").alias(c) for c, e in ITEMS])


def _rule_sql(r):
    safe = lambda e: __import__("re").sub(r"/ (\w+)", r"/ nullif(\1, 0)", e) or "NULL"
    t = r.tolerance or 0.0
    off = {"identity": f"coalesce(abs(l / nullif(r, 0) - 1) > {t}, false) OR (r = 0 AND l <> 0)", "le": f"l > r * (1 + {t}) + 1e-12", "range": f"l < {r.lower} OR l > {r.upper}"}.get(r.kind, "CAST(NULL AS BOOLEAN)")
    return f"SELECT *, {off} AS off FROM (SELECT '{r.name}' AS relation, stock, month, {safe(r.lhs)} AS l, CAST({safe(r.rhs)} AS DOUBLE) AS r FROM dec WHERE {r.condition or 'true'}) WHERE l IS NOT NULL{' AND r IS NOT NULL' if r.rhs else ''}"


_LACKING = {"capex_le_assets": "WC04601", "roa": "WC08326"}
_DEC_SQL = f"""{WIDE_SQL}, de AS (SELECT u.*, w.sales, w.assets, w.equity FROM uni u JOIN wide w ON w.stock = u.stock AND w.month = u.month WHERE month(u.month) = 12), dec AS (SELECT stock, month, {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in ITEMS)} FROM de),
 c AS ({' UNION ALL '.join(_rule_sql(r) for r in rel.FIRM_RULES if r.name not in _LACKING)})"""
_TABLE = ", ".join(f"('{r.name}', '{r.kind}', '{'skipped (missing ' + _LACKING[r.name] + ')' if r.name in _LACKING else ''}')" for r in rel.FIRM_RULES)


@query("qc19_relations", f"""{_DEC_SQL}, t AS (SELECT * FROM (VALUES {_TABLE}) t(relation, kind, st)), k AS (SELECT *, rank() OVER (PARTITION BY relation ORDER BY l) + (count(*) OVER (PARTITION BY relation, l) - 1) / 2 AS a, rank() OVER (PARTITION BY relation ORDER BY r) + (count(*) OVER (PARTITION BY relation, r) - 1) / 2 AS b FROM c WHERE r IS NOT NULL),
 s AS (SELECT relation, corr(a, b) AS spearman FROM k GROUP BY 1 HAVING count(*) > 2), g AS (SELECT relation, count(*) AS n, avg(CAST(off AS INT)) AS violations, median(l / nullif(r, 0)) AS median_ratio, avg(CAST(abs(l / nullif(r, 0) - 1) <= 0.05 AS INT)) AS within, avg(CASE WHEN r IS NOT NULL THEN CAST(l = 0 AND r = 0 AS INT) END) AS both_zero FROM c GROUP BY 1)
 SELECT relation, kind, CASE WHEN st <> '' THEN st WHEN n IS NULL THEN 'no overlapping observations' ELSE 'ok' END AS status, coalesce(n, 0) AS n, round(violations, 9) AS violations, round(median_ratio, 7) AS median_ratio, round(CASE WHEN kind IN ('identity', 'compare') THEN within END, 9) AS within, round(both_zero, 9) AS both_zero, round(spearman, 6) AS spearman
 FROM t LEFT JOIN g USING (relation) LEFT JOIN s USING (relation)""")
def qc19(spark, sf_dir):
    """The thirteen rules on the December cross-sections; two name items that the panel lacks."""
    d = december(spark, sf_dir)
    out = rel.summary(d, rel.evaluated(d, rel.FIRM_RULES), rel.FIRM_RULES).drop("lhs", "rhs", "condition")
    return _r(_r(_r(out, 9, "violations", "within", "both_zero"), 7, "median_ratio"), 6, "spearman")


@query("qc19_violations_by_year", f"{_DEC_SQL} SELECT relation, year(month) AS year, round(avg(CAST(off AS INT)), 9) AS violations, count(*) AS n FROM c WHERE off IS NOT NULL GROUP BY 1, 2")
def qc19_years(spark, sf_dir):
    return _r(rel.by_year(rel.evaluated(december(spark, sf_dir), rel.FIRM_RULES)), 9, "violations").withColumn("year", F.col("year").cast("long"))


@query("qc19_examples", f"{_DEC_SQL} SELECT relation, stock, month, round(l, 5) AS lhs, round(r, 5) AS rhs, rank FROM (SELECT *, row_number() OVER (PARTITION BY relation ORDER BY stock, month) AS rank FROM c WHERE off) WHERE rank <= 50")
def qc19_examples(spark, sf_dir):
    """The first fifty violations of each rule."""
    return _r(rel.examples(rel.evaluated(december(spark, sf_dir), rel.FIRM_RULES)), 5, "lhs", "rhs").withColumn("rank", F.col("rank").cast("long"))
