"""Queries of listing selection, static checks and import jobs, on listings, cells and files that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import listings as li
from ledgerline.plans.registry import query
from ledgerline.plans.universe_queries import universe
from ledgerline.sources import imports as im
from ledgerline.sources import static_files as sf
from ledgerline.sources.proxy import PANEL_SQL, read

LINES_SQL = """WITH lines AS (SELECT p_partkey AS stock, p_name || CASE p_partkey % 11 WHEN 0 THEN ' DEAD - DELIST.17/04/96' WHEN 1 THEN ' DUPL SEE 12' WHEN 2 THEN ' DELIST.03/12/07' ELSE '' END AS ename,
 CASE p_partkey % 7 WHEN 0 THEN 'ORD' WHEN 1 THEN 'PREF' WHEN 2 THEN ' ' WHEN 3 THEN 'na' ELSE 'FULLPAID' END AS code, 'C' || (p_size % 5) AS country, p_size % 5 AS country_order, p_brand AS exchange,
 CASE WHEN p_partkey % 9 = 0 THEN 'Bonds' ELSE 'Equities' END AS category, 'X' || (p_size % 3) AS currency, CASE WHEN p_partkey % 5 <> 0 THEN p_brand || (p_partkey // 30) ELSE 'NA' END AS loc, 'I' || (p_partkey // 2) AS isin,
 CASE WHEN p_partkey % 4 = 0 THEN 'P' ELSE 'S' END AS isinid, CASE WHEN p_partkey % 6 = 0 THEN 'C9' ELSE 'C' || (p_size % 5) END AS domicile, p_partkey % 3 <> 0 AS active FROM part)
"""
PATTERNS = [("C0", " re", False), ("C1", "small", True), ("C1", "blue", False), ("C2", "a", True), ("C3", "zzz", False)]
VENUES = [("C0", "brand#1"), ("C1", "BRAND#[12]"), ("C2", "^$"), ("C3", "#3"), ("C4", "brand#(4|5)"), ("C7", "x")]


def _values(rows, *names):
    cells = ", ".join("(" + ", ".join(str(x).upper() if isinstance(x, bool) else f"'{x}'" for x in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {cells}) t({', '.join(names)}))"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), (F.col("p_size") % 5).cast("string")
    status = F.when(k % 11 == 0, " DEAD - DELIST.17/04/96").when(k % 11 == 1, " DUPL SEE 12").when(k % 11 == 2, " DELIST.03/12/07").otherwise("")
    code = F.when(k % 7 == 0, "ORD").when(k % 7 == 1, "PREF").when(k % 7 == 2, " ").when(k % 7 == 3, "na").otherwise("FULLPAID")
    country, text = F.concat(F.lit("C"), size), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    return read(spark, sf_dir, "part").select(
        k.alias("stock"), F.concat("p_name", status).alias("ename"), code.alias("code"), country.alias("country"), (F.col("p_size") % 5).alias("country_order"), F.col("p_brand").alias("exchange"),
        F.when(k % 9 == 0, "Bonds").otherwise("Equities").alias("category"), text("X", F.col("p_size") % 3).alias("currency"), F.when(k % 5 != 0, F.concat("p_brand", F.floor(k / 30).cast("string"))).otherwise("NA").alias("loc"),
        text("I", F.floor(k / 2)).alias("isin"), F.when(k % 4 == 0, "P").otherwise("S").alias("isinid"), F.when(k % 6 == 0, "C9").otherwise(country).alias("domicile"), (k % 3 != 0).alias("active"),
    )


def frame(spark, rows, names):
    return spark.createDataFrame(rows, names)


def patterns(spark):
    return frame(spark, PATTERNS, "country string, pattern string, overridable boolean")


def venues(spark):
    return frame(spark, VENUES, "country string, pattern string")


_KNOWN = "('', 'NA', '#NA', '#N/A', 'N/A', 'NAN', 'NONE', 'NULL')"
_CORE = f"""pat AS {_values(PATTERNS, 'country', 'pattern', 'overridable')}, ven AS {_values(VENUES, 'country', 'pattern')},
 core AS (SELECT *, ' ' || trim(regexp_replace(ename, '\\s+(DEAD|DELIST\\.|DUPL)(\\s|\\d|$).*$', '')) || ' ' AS core, CASE WHEN upper(trim(code)) NOT IN {_KNOWN} THEN upper(trim(code)) END AS c FROM lines),
 hit AS (SELECT stock, bool_or(NOT overridable) AS strict FROM core JOIN pat ON pat.country = core.country AND contains(core, pattern) GROUP BY 1),
 f1 AS (SELECT core.* FROM core LEFT JOIN hit USING (stock) WHERE (c IS NULL OR c IN ('ORD', 'ORDSUBR', 'FULLPAID', 'UKNOWN', 'UNKNOW', 'KNOW')) AND (strict IS NULL OR (coalesce(c = 'ORD', false) AND NOT strict)) AND NOT contains(ename, ' DUPL')),
 f2 AS (SELECT * FROM f1 WHERE NOT regexp_matches(ename, 'DELIST\\.17')),
 f3a AS (SELECT * FROM (SELECT *, CASE WHEN upper(trim(loc)) NOT IN {_KNOWN} THEN loc END AS k FROM f2) QUALIFY NOT (k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AND bool_or(isinid = 'P') OVER (PARTITION BY k) AND isinid <> 'P')),
 f3 AS (SELECT * FROM f3a QUALIFY NOT (count(*) OVER (PARTITION BY isin) > 1 AND bool_or(isinid = 'P') OVER (PARTITION BY isin) AND isinid <> 'P'))"""


@query("f1_common_stocks", f"{LINES_SQL}, {_CORE} SELECT stock, ename FROM f1")
def f1(spark, sf_dir):
    return li.common_stocks(lines(spark, sf_dir), patterns(spark)).select("stock", "ename")


def _crossed(spark, df):
    return li.without_cross_listings(df, frame(spark, [(f"C{k}", r"DELIST\.17") for k in range(5)], "country string, pattern string"))


@query("f2_cross_listings", f"{LINES_SQL} SELECT stock, ename FROM lines WHERE NOT regexp_matches(ename, 'DELIST\\.17')")
def f2(spark, sf_dir):
    return _crossed(spark, lines(spark, sf_dir)).select("stock", "ename")


@query("f3_duplicate_codes", f"""{LINES_SQL}, a AS (SELECT * FROM (SELECT *, CASE WHEN upper(trim(loc)) NOT IN {_KNOWN} THEN loc END AS k FROM lines) QUALIFY NOT (k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AND bool_or(isinid = 'P') OVER (PARTITION BY k) AND isinid <> 'P'))
 SELECT stock FROM a QUALIFY NOT (count(*) OVER (PARTITION BY isin) > 1 AND bool_or(isinid = 'P') OVER (PARTITION BY isin) AND isinid <> 'P')""")
def f3(spark, sf_dir):
    return li.without_duplicate_codes(lines(spark, sf_dir), "loc", "isin").select("stock")


@query("f4_domestic", f"{LINES_SQL} SELECT stock, country FROM lines WHERE domicile = country OR (country = 'C2' AND domicile = 'C9')")
def f4(spark, sf_dir):
    aliases = frame(spark, [(f"C{k}", f"C{k}") for k in range(5)] + [("C2", "C9")], "country string, domicile string")
    return li.domestic(lines(spark, sf_dir), aliases).select("stock", "country")


CURRENCIES = [("C0", "X0"), ("C0", "X1"), ("C1", "X2"), ("C3", "X0")]


@query("f5_domestic_currency", f"{LINES_SQL} SELECT stock, country, currency FROM lines WHERE (country, currency) IN (('C0', 'X0'), ('C0', 'X1'), ('C1', 'X2'), ('C3', 'X0'))")
def f5(spark, sf_dir):
    return li.domestic_currency(lines(spark, sf_dir), frame(spark, CURRENCIES, "country string, currency string")).select("stock", "country", "currency")


@query("f6_large_countries", f"{LINES_SQL} SELECT stock, country FROM lines WHERE country IN (SELECT country FROM lines GROUP BY 1 HAVING count(DISTINCT stock) >= (SELECT count(*) / 5 FROM lines))")
def f6(spark, sf_dir):
    x = lines(spark, sf_dir)
    return li.large_countries(x, -(-x.count() // 5)).select("stock", "country")


@query("fx3_delisting_dates", f"{LINES_SQL} SELECT stock, CASE stock % 11 WHEN 0 THEN DATE '1996-04-17' WHEN 2 THEN DATE '2007-12-03' END AS delisted FROM lines WHERE stock % 11 IN (0, 2)")
def fx3(spark, sf_dir):
    return lines(spark, sf_dir).select("stock", li.delisting_in_name(F.col("ename")).alias("delisted")).where("delisted is not null")


@query("lst1_domestic_listings", f"{LINES_SQL}, ven AS {_values(VENUES, 'country', 'pattern')} SELECT stock, lines.country, exchange FROM lines JOIN ven USING (country) WHERE category = 'Equities' AND regexp_matches(exchange, pattern, 'i')")
def lst1(spark, sf_dir):
    return li.domestic_listings(lines(spark, sf_dir), venues(spark)).select("stock", "country", "exchange")


@query("lst4_first_country", f"{LINES_SQL}, l AS (SELECT stock, country, country_order, exchange FROM lines UNION ALL SELECT stock, 'C' || ((country_order + 2) % 5), (country_order + 2) % 5, exchange FROM lines WHERE stock % 3 = 0) SELECT stock, country, exchange FROM l QUALIFY row_number() OVER (PARTITION BY stock ORDER BY country_order, country) = 1")
def lst4(spark, sf_dir):
    """Every third stock stands in the list of a second country too."""
    one = lines(spark, sf_dir).select("stock", "country", "country_order", "exchange")
    order = (F.col("country_order") + 2) % 5
    two = one.where("stock % 3 = 0").select("stock", F.concat(F.lit("C"), order.cast("string")).alias("country"), order.alias("country_order"), "exchange")
    return li.first_country(one.unionByName(two)).select("stock", "country", "exchange")


# Lines of export files: some lines of another country, some without an exchange, codes with and without suffix, some lines twice.
_EXPORT_SQL = f"""{LINES_SQL}, ven AS (SELECT * FROM {_values(VENUES, 'country', 'pattern')} WHERE country <> 'C3'), x0 AS (SELECT stock, 'F' || country AS file, CASE WHEN stock % 50 = 7 AND country = 'C1' THEN 'C9' ELSE country END AS country, category, CASE WHEN stock % 40 = 3 THEN '-' WHEN stock % 77 = 5 THEN NULL ELSE exchange END AS exchange, active, currency,
  CASE stock % 4 WHEN 0 THEN 'R' || stock || '.VI' WHEN 1 THEN 'R.' || CASE WHEN stock % 3 = 0 THEN 'F' ELSE 'DE' END || '^B22' WHEN 2 THEN 'R' || stock END AS ric FROM lines), x AS (SELECT * FROM x0 UNION ALL SELECT * FROM x0 WHERE stock % 90 = 1)"""


def export(spark, sf_dir):
    k = F.col("stock")
    ric = F.when(k % 4 == 0, F.concat(F.lit("R"), k, F.lit(".VI"))).when(k % 4 == 1, F.concat(F.lit("R."), F.when(k % 3 == 0, "F").otherwise("DE"), F.lit("^B22"))).when(k % 4 == 2, F.concat(F.lit("R"), k))
    x = lines(spark, sf_dir).withColumn("file", F.concat(F.lit("F"), "country")).withColumn("country", F.when((k % 50 == 7) & (F.col("country") == "C1"), "C9").otherwise(F.col("country")))
    x = x.withColumn("exchange", F.when(k % 40 == 3, "-").when(k % 77 != 5, F.col("exchange"))).withColumn("ric", ric)
    return x.unionByName(x.where("stock % 90 = 1"))


def some_venues(spark):
    return venues(spark).where("country <> 'C3'")


_DOMESTIC = "CASE WHEN pattern = '^$' THEN false WHEN pattern IS NOT NULL THEN coalesce(regexp_matches(exchange, pattern, 'i'), false) END"


@query("lst2_exchange_report", f"""{_EXPORT_SQL}, m AS (SELECT x.* EXCLUDE (exchange), coalesce(exchange, '') AS exchange, {_DOMESTIC} AS domestic, nullif(regexp_extract(split_part(ric, '^', 1), '\\.([A-Za-z]+)$', 1), '') AS suffix FROM x LEFT JOIN ven USING (country)),
 tv AS (SELECT country, exchange, 's' AS k, suffix AS v, count(*) AS c FROM m WHERE suffix IS NOT NULL GROUP BY ALL UNION ALL SELECT country, exchange, 'c', currency, count(*) FROM m GROUP BY ALL), tr AS (SELECT *, row_number() OVER (PARTITION BY country, exchange, k ORDER BY c DESC, v) AS r FROM tv),
 ta AS (SELECT country, exchange, string_agg(v, '; ' ORDER BY r) FILTER (k = 's') AS suffixes, string_agg(v, '; ' ORDER BY r) FILTER (k = 'c') AS currencies FROM tr WHERE r <= 2 GROUP BY 1, 2)
 SELECT country, exchange, n, active, domestic, suffixes, currencies, round(n / sum(n) OVER (PARTITION BY country), 3) AS share FROM (SELECT country, exchange, count(*) AS n, count(*) FILTER (active) AS active, bool_and(domestic) AS domestic FROM m GROUP BY 1, 2) JOIN ta USING (country, exchange)""")
def lst2(spark, sf_dir):
    return li.exchange_report(export(spark, sf_dir), some_venues(spark), 2)


@query("lst3_exchange_warnings", f"""{_EXPORT_SQL}, own AS (SELECT file, country FROM (SELECT file, country, count(*) AS c FROM x GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY file ORDER BY c DESC, country) = 1), o AS (SELECT x.* EXCLUDE (country), own.country FROM x JOIN own USING (file)),
 q AS (SELECT o.*, {_DOMESTIC} AS domestic FROM o JOIN ven USING (country) WHERE category = 'Equities'), g AS (SELECT country, coalesce(exchange, '') AS exchange, count(*) AS n, bool_and(domestic) AS domestic FROM q GROUP BY 1, 2), e AS (SELECT *, round(n / sum(n) OVER (PARTITION BY country), 3) AS share, row_number() OVER (PARTITION BY country ORDER BY n DESC, exchange) AS r, bool_or(domestic) OVER (PARTITION BY country) AS has_one FROM g)
 SELECT own.country, 'several countries' AS rule, string_agg(DISTINCT x.country, '; ' ORDER BY x.country) AS detail FROM x JOIN own USING (file) GROUP BY file, own.country HAVING count(DISTINCT x.country) <> 1
 UNION ALL SELECT country, 'no equities', CAST(count(*) AS VARCHAR) FROM o WHERE category <> 'Equities' GROUP BY 1 UNION ALL SELECT country, 'no pattern', '' FROM own WHERE country NOT IN (SELECT country FROM ven) UNION ALL SELECT DISTINCT country, 'no domestic line', '' FROM e WHERE NOT has_one
 UNION ALL SELECT country, 'largest exchange abroad', exchange FROM e WHERE r = 1 AND has_one AND NOT domestic
 UNION ALL SELECT country, 'large unknown exchange', exchange FROM e WHERE NOT domestic AND share >= 0.05 AND NOT EXISTS (SELECT 1 FROM ven WHERE ven.country <> e.country AND pattern <> '^$' AND regexp_matches(exchange, pattern, 'i'))
 UNION ALL SELECT country, 'no exchange name', CAST(count(*) AS VARCHAR) FROM q WHERE coalesce(exchange, '-') IN ('-', '') GROUP BY 1 UNION ALL SELECT country, 'repeated ids', CAST(count(*) - count(DISTINCT stock) AS VARCHAR) FROM q WHERE domestic GROUP BY 1 HAVING count(*) > count(DISTINCT stock)
 UNION ALL SELECT country, 'no file', '' FROM (SELECT unnest(['C0', 'C1', 'C7', 'C8']) AS country) WHERE country NOT IN (SELECT country FROM own)""")
def lst3(spark, sf_dir):
    return li.exchange_warnings(export(spark, sf_dir), some_venues(spark), frame(spark, [("C0",), ("C1",), ("C7",), ("C8",)], "country string"), 0.05)


@query("lst5_batches", """WITH i AS (SELECT o_orderkey AS place, CASE WHEN o_custkey % 5 = 0 THEN ' ' || o_custkey || 'X ' WHEN o_custkey % 5 = 1 THEN '0' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS stock FROM orders), d AS (SELECT trim(stock) AS stock, min(place) AS place FROM i GROUP BY 1), r AS (SELECT stock, row_number() OVER (ORDER BY place, stock) - 1 AS k FROM d), n AS (SELECT stock, k, CAST(k // 100 + 1 AS VARCHAR) AS number FROM r)
 SELECT stock, 'L#A' || CASE WHEN length(number) < 3 THEN lpad(number, 3, '0') ELSE number END AS list, k % 100 + 1 AS row FROM n""")
def lst5(spark, sf_dir):
    """Ids in the order in which orders first name them, some with letters, blanks or leading zeros."""
    k = F.col("o_custkey").cast("string")
    code = F.when(F.col("o_custkey") % 5 == 0, F.concat(F.lit(" "), k, F.lit("X "))).when(F.col("o_custkey") % 5 == 1, F.concat(F.lit("0"), k)).otherwise(k)
    return li.batches(read(spark, sf_dir, "orders").select(code.alias("stock"), F.col("o_orderkey").alias("at")), 100, "A")


@query("stc1_normal_ids", "SELECT c_custkey AS stock, CASE WHEN c_custkey % 3 = 2 THEN 'A' || c_custkey ELSE CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 6 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') ELSE CAST(c_custkey AS VARCHAR) END END AS id FROM customer")
def stc1(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".0"))).when(k % 3 == 1, F.concat(F.lit(" "), k.cast("string"))).otherwise(F.concat(F.lit("A"), k.cast("string")))
    return read(spark, sf_dir, "customer").select(k.alias("stock"), li.normal_id(raw).alias("id"))


_CELLS = "SELECT c_custkey AS stock, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'n' || c_nationkey END AS a, CASE WHEN c_custkey % 8 = 0 THEN '$$ER: 0904' WHEN c_custkey % 4 = 0 THEN 'v' ELSE NULL END AS b FROM customer"


def _cells(spark, sf_dir):
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(k.alias("stock"), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("a"), F.when(k % 8 == 0, "$$ER: 0904").when(k % 4 == 0, "v").alias("b"))


@query("stc2_unresolved", f"SELECT stock FROM ({_CELLS}) WHERE (a IS NULL OR trim(a) = '') AND (b IS NULL OR starts_with(b, '$$ER'))")
def stc2(spark, sf_dir):
    return li.unresolved(_cells(spark, sf_dir), ["a", "b"]).select("stock")


_EXPECTED = "e0 AS (SELECT CASE WHEN c_custkey % 10 = 3 THEN c_custkey || 'E' || (c_custkey % 7) ELSE CAST(c_custkey AS VARCHAR) END AS stock, 'L' || (c_nationkey % 4) AS list FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'L9' FROM customer WHERE c_custkey % 35 = 1), f0 AS (SELECT CASE WHEN o_custkey % 20 = 3 THEN o_custkey || 'E' || (o_custkey % 7) ELSE CAST(o_custkey AS VARCHAR) END AS stock FROM orders WHERE o_custkey % 7 <> 0)"


def _compared(spark, sf_dir):
    """Ids of lists, some in two of them and some that look like numbers, and ids found, some of these as the numbers they were read as."""
    k, text = F.col("c_custkey"), lambda c: F.concat(c, F.lit("E"), c % 7)
    c, o = read(spark, sf_dir, "customer"), F.col("o_custkey")
    expected = c.where("c_custkey % 5 <> 0").select(F.when(k % 10 == 3, text(k)).otherwise(k.cast("string")).alias("stock"), F.concat(F.lit("L"), F.col("c_nationkey") % 4).alias("list"))
    expected = expected.unionByName(c.where("c_custkey % 35 = 1").select(k.cast("string").alias("stock"), F.lit("L9").alias("list")))
    return expected, read(spark, sf_dir, "orders").where("o_custkey % 7 <> 0").select(F.when(o % 20 == 3, text(o)).otherwise(o.cast("string")).alias("stock"))


@query("stc3_compare_sets", f"WITH {_EXPECTED}, e AS (SELECT stock, count(*) AS e FROM e0 GROUP BY 1), f AS (SELECT stock, count(*) AS f FROM f0 GROUP BY 1) SELECT count(*) FILTER (e IS NOT NULL AND f IS NOT NULL) AS both, count(*) FILTER (f IS NULL) AS missing, count(*) FILTER (e IS NULL) AS unexpected, count(*) FILTER (f > 1) AS duplicated, count(*) FILTER (e > 1) AS in_several_lists, count(*) FILTER (e IS NOT NULL AND regexp_full_match(stock, '\\d+E\\d+')) AS risky, count(*) FILTER (f IS NULL AND regexp_full_match(stock, '\\d+E\\d+')) AS risky_missing FROM e FULL JOIN f USING (stock)")
def stc3(spark, sf_dir):
    return li.compare_sets(*_compared(spark, sf_dir))


@query("stc3_missing_by_list", f"WITH {_EXPECTED} SELECT list, count(*) AS n, count(*) FILTER (stock NOT IN (SELECT stock FROM f0)) AS missing FROM e0 GROUP BY 1")
def stc3_missing(spark, sf_dir):
    return li.missing_by_list(*_compared(spark, sf_dir))


@query("stc4_best_list", """WITH l AS (SELECT c_custkey AS stock, 'L' || (c_nationkey % 4) AS list FROM customer), f AS (SELECT c_custkey AS stock, 'L' || ((c_nationkey + CASE WHEN c_nationkey % 4 = 1 AND c_custkey % 3 > 0 THEN 1 ELSE 0 END) % 4) AS folder FROM customer),
 t AS (SELECT folder, count(*) AS total FROM f GROUP BY 1), g AS (SELECT folder, list, count(*) AS n FROM f JOIN l USING (stock) GROUP BY 1, 2), b AS (SELECT folder, list AS best FROM g QUALIFY row_number() OVER (PARTITION BY folder ORDER BY n DESC, list) = 1)
 SELECT t.folder, coalesce(g.n / total, 0.0) AS own_share, CASE WHEN coalesce(g.n / total, 0.0) < 0.9 THEN best END AS best FROM t LEFT JOIN g ON g.folder = t.folder AND g.list = t.folder LEFT JOIN b ON b.folder = t.folder""")
def stc4(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer"), F.col("c_nationkey")
    moved = (n + F.when((n % 4 == 1) & (F.col("c_custkey") % 3 > 0), 1).otherwise(0)) % 4
    name = lambda x: F.concat(F.lit("L"), x.cast("string"))
    return li.best_list(c.select(F.col("c_custkey").alias("stock"), name(n % 4).alias("list")), c.select(F.col("c_custkey").alias("stock"), name(moved).alias("folder")))


@query("stc5_field_coverage", f"SELECT 'a' AS field, avg(CAST(coalesce(trim(a), '') <> '' AS INT)) AS filled FROM ({_CELLS}) UNION ALL SELECT 'b', avg(CAST(coalesce(trim(b), '') <> '' AS INT)) FROM ({_CELLS})")
def stc5(spark, sf_dir):
    return li.field_coverage(_cells(spark, sf_dir), ["a", "b"])


_PLACED = "SELECT stock, country, CASE WHEN stock % 8 = 1 THEN NULL WHEN stock % 8 = 2 THEN ' ' || lower(domicile) ELSE domicile END AS domicile FROM lines"


def _placed(spark, sf_dir):
    k = F.col("stock")
    return lines(spark, sf_dir).withColumn("domicile", F.when(k % 8 == 2, F.concat(F.lit(" "), F.lower("domicile"))).when(k % 8 != 1, F.col("domicile")))


@query("stc6_domicile_match", f"{LINES_SQL} SELECT country, count(*) AS n, avg(CAST(coalesce(upper(trim(domicile)) = country, false) AS INT)) AS matching FROM ({_PLACED}) GROUP BY 1")
def stc6(spark, sf_dir):
    return li.domicile_match(_placed(spark, sf_dir))


@query("stc6_mismatches", f"{LINES_SQL} SELECT stock, country, domicile FROM ({_PLACED}) WHERE domicile IS NULL OR upper(trim(domicile)) <> country")
def stc6_mismatches(spark, sf_dir):
    return li.domicile_mismatches(_placed(spark, sf_dir)).select("stock", "country", "domicile")


def wide_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide vendor file derived from orders: a date column, a series for each of 25 groups of customers, error cells."""
    o = read(spark, sf_dir, "orders").withColumns({"Date": F.trunc("o_orderdate", "month").cast("string"), "s": F.col("o_custkey") % 25})
    o = o.groupBy("Date").pivot("s", list(range(25))).agg(F.max("o_totalprice"))
    bad = F.substring("Date", 6, 2) == "07"
    cols = [F.when(bad & F.lit(k % 5 == 0), "$$ER: E100").otherwise(F.col(f"`{k}`").cast("decimal(18,2)").cast("string")).alias(f"DPL#({k:05d}(P))" if k % 10 != 9 else f"series {k}") for k in range(25)]
    return o.select(F.when(F.col("Date") == "1995-02-01", "no date").otherwise(F.col("Date")).alias("Date"), *cols, F.lit("x").alias("#ERROR_1"))


_WIDE = """WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, CAST(o_custkey % 25 AS INT) AS k, max(o_totalprice) AS v FROM orders GROUP BY 1, 2),
 w AS (SELECT d, k, CASE WHEN month(d) = 7 AND k % 5 = 0 THEN '$$ER: E100' ELSE CAST(CAST(v AS DECIMAL(18,2)) AS VARCHAR) END AS cell, CASE WHEN k % 10 <> 9 THEN lpad(CAST(k AS VARCHAR), 5, '0') ELSE 'series ' || k END AS stock FROM o),
 l AS (SELECT stock, k, CASE WHEN d <> DATE '1995-02-01' THEN d END AS date, cell, TRY_CAST(cell AS DOUBLE) AS value FROM w)"""


@query("src1_wide_to_long", f"{_WIDE} SELECT stock, date, value FROM l WHERE date IS NOT NULL AND value IS NOT NULL")
def src1(spark, sf_dir):
    return im.wide_to_long(wide_file(spark, sf_dir)).where("date is not null and value is not null").select("stock", "date", "value")


_HEADED = f"""{_WIDE}, h AS (SELECT CASE WHEN k % 10 <> 9 THEN 'DPL#(' || stock || '(P))' ELSE stock END AS header, CASE WHEN d = DATE '1995-02-01' THEN 'no date' ELSE CAST(d AS VARCHAR) END AS raw_date, cell, TRY_CAST(cell AS DOUBLE) AS value FROM w)"""


@query("src2_numbers", f"{_HEADED} SELECT header, raw_date, value FROM h WHERE value IS NOT NULL")
def src2(spark, sf_dir):
    return im.melt(im.to_numbers(wide_file(spark, sf_dir))).where("value is not null").select("header", F.col("Date").alias("raw_date"), "value")


@query("src4_melt", f"{_HEADED} SELECT header, raw_date, cell FROM h WHERE cell NOT LIKE '$$%'")
def src4(spark, sf_dir):
    return im.melt(wide_file(spark, sf_dir).drop("#ERROR_1"), value="cell").where("cell not like '$$%'").select("header", F.col("Date").alias("raw_date"), "cell")


# Headers with an id in the vendor's form, with a bare id, with blanks before it, and without any.
_HEADERS = "SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'DPL#(' || p_partkey || '(P))' WHEN 1 THEN p_partkey || '(MV)~E' WHEN 2 THEN '  DPL#(' || p_partkey || 'X(UP))' WHEN 3 THEN '(' || p_partkey || ')' ELSE p_name END AS header FROM part"


def _headers(spark, sf_dir):
    k = F.col("p_partkey")
    text = lambda before, after: F.concat(F.lit(before), k.cast("string"), F.lit(after))
    header = F.when(k % 5 == 0, text("DPL#(", "(P))")).when(k % 5 == 1, text("", "(MV)~E")).when(k % 5 == 2, text("  DPL#(", "X(UP))")).when(k % 5 == 3, text("(", ")")).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select(k.alias("k"), header.alias("header"))


_OWN_ID = "nullif(regexp_extract(header, '^\\s*(?:DPL#\\()?([^(\\s]+)\\(', 1), '')"


@query("src3_fix_ids", f"SELECT k, header, coalesce({_OWN_ID}, header) AS stock, CAST({_OWN_ID} IS NOT NULL AS INT) AS matched FROM ({_HEADERS})")
def src3(spark, sf_dir):
    return im.fix_ids(_headers(spark, sf_dir)).withColumn("matched", F.col("matched").cast("int"))


@query("src8_series_id", f"SELECT k, {_OWN_ID} AS id FROM ({_HEADERS}) WHERE {_OWN_ID} IS NOT NULL")
def src8(spark, sf_dir):
    return _headers(spark, sf_dir).select("k", im.series_id(F.col("header")).alias("id")).where("id is not null")


@query("src7_file_report", f"""{_WIDE}, dates AS (SELECT DISTINCT CASE WHEN d = DATE '1995-02-01' THEN NULL ELSE d END AS date, d FROM o), k AS (SELECT unnest(generate_series(0, 24)) AS k)
 SELECT 'orders' AS file, 25 AS series, 2 AS unparsed, (SELECT count(*) FROM l WHERE date IS NOT NULL AND value IS NOT NULL) AS obs, (SELECT count(*) FROM dates WHERE date IS NULL) AS bad_dates, (SELECT count(*) FROM (SELECT DISTINCT month(d) AS m, year(d) AS y FROM o WHERE month(d) = 7)) * 5 AS coerced, '$$ER: E100' AS examples, 0 AS duplicates, (SELECT count(DISTINCT stock) FROM l WHERE value IS NOT NULL AND date IS NOT NULL) AS firms, 'check' AS status""")
def src7(spark, sf_dir):
    return im.file_report(im.wide_to_long(wide_file(spark, sf_dir)).withColumn("file", F.lit("orders")))


@query("src9_cell_dates", "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderkey % 3 <> 2")
def src9(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    serial = F.date_diff("d", F.lit("1899-12-30").cast("date")).cast("string")
    cell = F.when(F.col("o_orderkey") % 3 == 0, serial).when(F.col("o_orderkey") % 3 == 1, F.col("d").cast("string")).otherwise("12 monkeys")
    return o.select(F.col("o_orderkey").alias("id"), im.cell_dates(cell).alias("date")).where("date is not null")


_FILES = "SELECT o_custkey AS stock, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS file, max(o_totalprice) AS value FROM orders GROUP BY 1, 2, 3"


def _files(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("stock"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("file")).agg(F.max("o_totalprice").alias("value"))


@query("src10_merge_files", f"SELECT stock, date, value, file FROM ({_FILES}) QUALIFY row_number() OVER (PARTITION BY stock, date ORDER BY file, value) = 1")
def src10(spark, sf_dir):
    return im.merge_files(_files(spark, sf_dir))


@query("src10_conflicts", f"SELECT count(*) AS repeated, count(*) FILTER (k > 1) AS conflicting FROM (SELECT stock, date, count(*) AS n, count(DISTINCT value) AS k FROM ({_FILES}) GROUP BY 1, 2 HAVING count(*) > 1)")
def src10c(spark, sf_dir):
    return im.conflicts(_files(spark, sf_dir))


_VARS = "SELECT o_orderpriority AS variable, CASE WHEN o_orderpriority LIKE '1%' THEN last_day(CAST(o_orderdate AS DATE)) WHEN o_orderpriority LIKE '2%' THEN CAST(date_trunc('month', o_orderdate) + INTERVAL 14 DAY AS DATE) ELSE CAST(o_orderdate AS DATE) END AS date FROM orders"


@query("src11_date_convention", f"SELECT variable, CASE WHEN bool_and(date = last_day(date)) THEN 'month_end' WHEN count(DISTINCT day(date)) = 1 THEN 'day_' || lpad(CAST(min(day(date)) AS VARCHAR), 2, '0') ELSE 'mixed' END AS convention FROM ({_VARS}) GROUP BY 1")
def src11(spark, sf_dir):
    d, p = F.col("o_orderdate").cast("date"), F.col("o_orderpriority")
    date = F.when(p.startswith("1"), F.last_day(d)).when(p.startswith("2"), F.date_add(F.trunc(d, "month"), 14)).otherwise(d)
    return im.date_convention(read(spark, sf_dir, "orders").select(p.alias("variable"), date.alias("date")))


@query("src12_align_month_end", "SELECT 'price' AS variable, o_custkey AS stock, last_day(CAST(o_orderdate AS DATE)) AS month, max(o_totalprice) AS value FROM orders GROUP BY 2, 3")
def src12(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.lit("price").alias("variable"), F.col("o_custkey").alias("stock"), F.trunc("o_orderdate", "month").alias("date")).agg(F.max("o_totalprice").alias("value"))
    return im.align_month_end(o)


_LOG = "SELECT o_orderpriority AS variable, o_orderkey AS rows, o_orderstatus AS status, o_orderkey AS imported_at FROM orders"


@query("src14_import_log", f"SELECT variable, arg_max(rows, imported_at) AS rows, max(imported_at) AS imported_at FROM ({_LOG}) GROUP BY 1")
def src14(spark, sf_dir):
    return im.latest_log(read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("variable"), F.col("o_orderkey").alias("rows"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("imported_at"))).drop("status")


@query("src16_needs_import", "WITH r AS (SELECT o_custkey AS variable, max(CAST(o_orderdate AS DATE)) AS raw_at FROM orders GROUP BY 1), p AS (SELECT o_custkey AS variable, max(CAST(o_orderdate AS DATE)) AS panel_at FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT variable, raw_at FROM r LEFT JOIN p USING (variable) WHERE panel_at IS NULL OR raw_at > panel_at")
def src16(spark, sf_dir):
    """Customers stand for variables, all their orders for the raw files, those filled for what the panel has."""
    last = lambda o, name: o.groupBy(F.col("o_custkey").alias("variable")).agg(F.max(F.col("o_orderdate").cast("date")).alias(name))
    o = read(spark, sf_dir, "orders")
    return im.needs_import(last(o, "raw_at"), last(o.where("o_orderstatus = 'F'"), "panel_at"))


@query("src15_inventory", """WITH r AS (SELECT n_name AS variable, CASE WHEN n_nationkey % 6 = 5 THEN 'static' ELSE 'timeseries' END AS type FROM nation), w AS (SELECT 'NATION_' || (c_nationkey + 2) AS variable, count(*) AS n_files, max(c_custkey) AS raw_at FROM customer WHERE c_nationkey % 4 > 0 GROUP BY 1), p AS (SELECT 'NATION_' || s_nationkey AS variable, max(s_suppkey) * 12 AS panel_at FROM supplier WHERE s_nationkey % 3 > 0 GROUP BY 1),
 l AS (SELECT 'NATION_' || (c_nationkey + 1) AS variable, CASE WHEN c_nationkey % 5 < 2 THEN 'incomplete' ELSE 'complete' END AS status, count(*) AS n_series, count(*) FILTER (c_custkey % 3 > 0) AS n_firms FROM customer WHERE c_nationkey % 7 > 0 GROUP BY 1, 2),
 m AS (SELECT variable, string_agg(name, ', ' ORDER BY name) AS in_merged FROM (SELECT DISTINCT 'NATION_' || s_nationkey AS variable, 'set' || (s_suppkey % 3) AS name FROM supplier) GROUP BY 1)
 SELECT variable, coalesce(type, 'timeseries') AS type, r.variable IS NOT NULL AS registered, coalesce(n_files, 0) AS n_files, CASE WHEN status = 'incomplete' THEN CASE WHEN panel_at IS NULL THEN 'blocked' ELSE 'incomplete' END WHEN panel_at IS NULL THEN 'missing' WHEN raw_at > panel_at THEN 'stale' ELSE 'current' END AS state, round(n_firms / n_series, 3) AS share_with_data, coalesce(in_merged, '') AS in_merged
 FROM r FULL JOIN w USING (variable) FULL JOIN p USING (variable) FULL JOIN l USING (variable) LEFT JOIN m USING (variable)""")
def src15(spark, sf_dir):
    name = lambda c: F.concat(F.lit("NATION_"), c.cast("string"))
    c, s, k = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier"), F.col("c_nationkey")
    w = c.where("c_nationkey % 4 > 0").groupBy(name(k + 2).alias("variable")).agg(F.count("*").alias("n_files"), F.max("c_custkey").alias("raw_at"))
    p = s.where("s_nationkey % 3 > 0").groupBy(name(F.col("s_nationkey")).alias("variable")).agg((F.max("s_suppkey") * 12).alias("panel_at"))
    log = c.where("c_nationkey % 7 > 0").groupBy(name(k + 1).alias("variable"), F.when(k % 5 < 2, "incomplete").otherwise("complete").alias("status")).agg(F.count("*").alias("n_series"), F.count_if(F.col("c_custkey") % 3 > 0).alias("n_firms"))
    merged = s.select(name(F.col("s_nationkey")).alias("variable"), F.concat(F.lit("set"), F.col("s_suppkey") % 3).alias("name"))
    registry = read(spark, sf_dir, "nation").select(F.col("n_name").alias("variable"), F.when(F.col("n_nationkey") % 6 == 5, "static").otherwise("timeseries").alias("type"))
    return im.inventory(registry, w, p, log, merged).select("variable", "type", "registered", "n_files", "state", "share_with_data", "in_merged")


# Cells of static files: two files for each of three snapshots; ids as numbers and as text, error cells, blanks, repeats.
_STATIC_SQL = """WITH c AS (SELECT 'f' || (c_custkey % 2) || '.csv' AS file, make_date(CAST(2001 + t.k AS INT), 6, 30) AS as_of, c_custkey * 4 + t.k AS line, CASE WHEN c_custkey % 30 = 7 THEN '  ' WHEN c_custkey % 5 = 0 THEN (c_custkey // 2) || '.0' WHEN c_custkey % 5 = 1 THEN ' A' || (c_custkey // 3) || ' ' ELSE CAST(c_custkey AS VARCHAR) END AS id, c_custkey % 5 <> 1 AND c_custkey % 30 <> 7 AS num,
  CASE WHEN c_custkey % 11 = t.k THEN '$$ER: E' || (c_nationkey % 7) WHEN c_custkey % 13 = 2 THEN ' #na' WHEN c_custkey % 17 = 3 THEN NULL WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 19 = 4 THEN 'soon' ELSE CAST(make_date(2000, CAST(1 + (c_nationkey + t.k * (c_custkey % 3)) % 12 AS INT), 28) AS VARCHAR) END ELSE 'kind ' || ((c_nationkey + t.k * (c_custkey % 3)) % 4) END AS cell FROM customer, generate_series(0, 2) t(k) WHERE (c_custkey + t.k) % 9 > 0),
 s AS (SELECT *, nullif(CASE WHEN num THEN CASE WHEN length(regexp_replace(trim(id), '\\.0$', '')) < 6 THEN lpad(regexp_replace(trim(id), '\\.0$', ''), 6, '0') ELSE regexp_replace(trim(id), '\\.0$', '') END ELSE trim(id) END, '') AS stock, cell IS NULL OR upper(trim(cell)) IN ('', 'NA', '#NA') AS mis, coalesce(starts_with(cell, '$$ER'), false) AS err FROM c),
 y AS (SELECT file, as_of, CASE WHEN 2 * count(*) FILTER (NOT mis AND NOT err AND try_cast(cell AS DATE) IS NOT NULL) >= count(*) FILTER (NOT mis AND NOT err) THEN 'date' ELSE 'text' END AS type FROM s GROUP BY 1, 2),
 z AS (SELECT s.*, type, NOT mis AND NOT err AND (type = 'text' OR try_cast(cell AS DATE) IS NOT NULL) AS ok FROM s JOIN y USING (file, as_of)), pn AS (SELECT stock, as_of, trim(cell) AS value, count(*) OVER (PARTITION BY stock, as_of) - 1 AS repeats FROM z WHERE ok AND stock IS NOT NULL QUALIFY row_number() OVER (PARTITION BY stock, as_of ORDER BY file, line) = 1)"""


def static_cells(spark, sf_dir):
    k, t, n = F.col("c_custkey"), F.col("t"), F.col("c_nationkey")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    half, third, turn = F.floor(k / 2), F.floor(k / 3), n + t * (k % 3)
    ident = F.when(k % 30 == 7, "  ").when(k % 5 == 0, text(half, ".0")).when(k % 5 == 1, text(" A", third, " ")).otherwise(k.cast("string"))
    dated = F.when(k % 19 == 4, "soon").otherwise(F.make_date(F.lit(2000), (1 + turn % 12).cast("int"), F.lit(28)).cast("string"))
    cell = F.when(k % 11 == t, text("$$ER: E", n % 7)).when(k % 13 == 2, " #na").when(k % 17 == 3, F.lit(None)).when(k % 2 == 0, dated).otherwise(text("kind ", turn % 4))
    c = read(spark, sf_dir, "customer").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(2)))).where("(c_custkey + t) % 9 > 0")
    return c.select(text("f", k % 2, ".csv").alias("file"), F.make_date(2001 + t, F.lit(6), F.lit(30)).alias("as_of"), (k * 4 + t).alias("line"), ident.alias("id"), ((k % 5 != 1) & (k % 30 != 7)).alias("numeric"), cell.alias("cell"))


@query("src17_static_files", f"""{_STATIC_SQL} SELECT file, as_of, count(stock) AS series, count(DISTINCT CASE WHEN ok THEN stock END) AS firms, count(*) FILTER (mis) AS missing, count(*) FILTER (err) AS errors, array_to_string(list_sort(list(DISTINCT cell) FILTER (err))[1:5], ' | ') AS examples, count(*) FILTER (NOT mis AND NOT err AND NOT ok) AS coerced,
  count(*) FILTER (num AND length(regexp_replace(trim(id), '\\.0$', '')) < 6) AS padded, count(*) FILTER (stock IS NULL) AS blank, any_value(type) AS type, count(*) FILTER (ok AND stock IS NOT NULL) - count(DISTINCT CASE WHEN ok THEN stock END) AS duplicates, 'ok' AS status FROM z GROUP BY 1, 2""")
def src17_files(spark, sf_dir):
    return sf.file_reports(sf.typed_cells(static_cells(spark, sf_dir)))


@query("src18_snapshot_report", f"""{_STATIC_SQL}, ds AS (SELECT as_of, lag(as_of) OVER (ORDER BY as_of) AS before FROM (SELECT DISTINCT as_of FROM pn)) SELECT pn.as_of, count(*) AS firms, count(DISTINCT pn.value) AS kinds, CAST(sum(pn.repeats) AS BIGINT) AS repeats, count(b.value) AS compared, count(*) FILTER (b.value <> pn.value) AS changed
 FROM pn JOIN ds USING (as_of) LEFT JOIN pn b ON b.stock = pn.stock AND b.as_of = ds.before GROUP BY 1""")
def src18_report(spark, sf_dir):
    return sf.snapshot_report(sf.snapshots(sf.typed_cells(static_cells(spark, sf_dir))))


@query("src18_value_distribution", f"{_STATIC_SQL} SELECT as_of, value, count(*) AS firms FROM pn GROUP BY 1, 2")
def src18_values(spark, sf_dir):
    return sf.value_distribution(sf.snapshots(sf.typed_cells(static_cells(spark, sf_dir))))


@query("src17_value_types", """WITH c AS (SELECT unnest(['brand', 'price', 'size']) AS variable, unnest([CAST(p_brand AS VARCHAR), CAST(p_retailprice AS VARCHAR), CASE WHEN p_size % 5 = 0 THEN '#NA' ELSE CAST(p_size AS VARCHAR) END]) AS cell FROM part
 UNION ALL SELECT 'shipped', CASE WHEN l_linenumber < 3 THEN 'unknown' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END FROM lineitem),
 g AS (SELECT variable, avg(CAST(try_cast(cell AS DOUBLE) IS NOT NULL AS INT)) AS num, avg(CAST(try_cast(cell AS DATE) IS NOT NULL AS INT)) AS dat FROM c WHERE cell <> '#NA' GROUP BY 1)
 SELECT variable, CASE WHEN num >= 0.5 THEN 'number' WHEN dat >= 0.5 THEN 'date' ELSE 'text' END AS type FROM g""")
def src17(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.explode(F.create_map(F.lit("brand"), "p_brand", F.lit("price"), F.col("p_retailprice").cast("string"), F.lit("size"), F.when(F.col("p_size") % 5 == 0, "#NA").otherwise(F.col("p_size").cast("string")))).alias("variable", "cell"))
    dates = read(spark, sf_dir, "lineitem").select(F.lit("shipped").alias("variable"), F.when(F.col("l_linenumber") < 3, "unknown").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("cell"))
    return im.value_types(p.union(dates))


_SNAPS = "SELECT c_custkey AS stock, make_date(CAST(2000 + k AS INT), 6, 30) AS as_of, CASE WHEN c_custkey % 10 < k THEN 'new' || (c_nationkey % 3) ELSE 'old' END AS value FROM customer, generate_series(0, 3) t(k) WHERE (c_custkey + k) % 6 > 0"


def _snaps(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).where("(c_custkey + k) % 6 > 0")
    return c.select(F.col("c_custkey").alias("stock"), F.make_date(2000 + F.col("k"), F.lit(6), F.lit(30)).alias("as_of"), F.when(F.col("c_custkey") % 10 < F.col("k"), F.concat(F.lit("new"), (F.col("c_nationkey") % 3).cast("string"))).otherwise("old").alias("value"))


@query("src18_snapshot_changes", f"SELECT as_of, count(*) AS firms, count(DISTINCT value) AS kinds, count(*) FILTER (changed) AS changed FROM (SELECT *, coalesce(lag(value) OVER (PARTITION BY stock ORDER BY as_of) <> value, false) AS changed FROM ({_SNAPS})) GROUP BY 1")
def src18(spark, sf_dir):
    return im.snapshot_changes(_snaps(spark, sf_dir))


@query("src19_static_as_of", f"SELECT stock, arg_max(value, as_of) AS value, max(as_of) AS as_of FROM ({_SNAPS}) WHERE as_of <= DATE '2002-01-01' GROUP BY 1")
def src19(spark, sf_dir):
    return im.static_as_of(_snaps(spark, sf_dir), "2002-01-01")


@query("src22_factor_lines", "SELECT last_day(CAST(o_orderdate AS DATE)) AS date, round(sum(o_totalprice) / 100, 2) / 100 AS market, 0.0025 AS rf FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1")
def src22(spark, sf_dir):
    """Lines of a factor file that Spark writes from monthly sums of orders, with a heading, and a yearly part at the end."""
    m = read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("m")).agg(F.round(F.sum("o_totalprice") / 100, 2).alias("v"))
    text = m.select(F.col("m").cast("long").alias("line"), F.concat(F.lit("  "), "m", F.lit("   "), F.col("v").cast("decimal(18,2)").cast("string"), F.lit("  0.25")).alias("text"))
    extra = read(spark, sf_dir, "region").select(F.when(F.col("r_regionkey") == 0, 1).otherwise(199800).cast("long").alias("line"), F.when(F.col("r_regionkey") == 0, "Factors").otherwise(" Annual Factors").alias("text"))
    return im.factor_lines(text.union(extra))


@query("src23_month_end_rates", "WITH e AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, max(value) AS v FROM events GROUP BY 1, 2) SELECT series, last_day(date) AS month, arg_max(v, date) AS rate, count(*) AS n FROM e WHERE day(date) % 7 <> 3 GROUP BY 1, 2")
def src23(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("date")).agg(F.max("value").alias("v"))
    return im.month_end_rates(e.withColumn("cell", F.when(F.dayofmonth("date") % 7 == 3, ".").otherwise(F.col("v").cast("string"))))


@query("src24_index_returns", """WITH o AS (SELECT o_orderstatus AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, max(o_totalprice) AS level FROM orders GROUP BY 1, 2), m AS (SELECT series, last_day(CAST(date - INTERVAL 1 DAY AS DATE)) AS month, level FROM o)
 SELECT series, month, round(CASE WHEN date_diff('month', lag(month) OVER w, month) = 1 THEN level / lag(level) OVER w - 1 END, 8) AS ret FROM m WINDOW w AS (PARTITION BY series ORDER BY month)""")
def src24(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("series"), F.trunc("o_orderdate", "month").alias("date")).agg(F.max("o_totalprice").alias("level"))
    return im.index_returns(o).select("series", "month", F.round("ret", 8).alias("ret"))


@query("src25_date_profile", "WITH d AS (SELECT DISTINCT o_orderstatus AS series, CAST(o_orderdate AS DATE) AS date FROM orders), g AS (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY series ORDER BY date), date) AS gap FROM d) SELECT series, count(*) AS n, min(date) AS first, max(date) AS last, avg(CAST(date = last_day(date) AS INT)) AS month_end, avg(CAST(day(date) = 1 AS INT)) AS day_one, median(gap) AS median_gap FROM g GROUP BY 1")
def src25(spark, sf_dir):
    return im.date_profile(read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("series"), F.col("o_orderdate").cast("date").alias("date")))


@query("snk1_output_metrics", f"{PANEL_SQL} SELECT count(*) AS rows, count(DISTINCT stock) AS stocks, min(month) AS first, max(month) AS last, count(close) AS n_close FROM uni")
def snk1(spark, sf_dir):
    return im.output_metrics(universe(spark, sf_dir), "close")


@query("snk2_readable_names", f"{PANEL_SQL} SELECT stock, month, close AS price, market_cap AS cap FROM uni")
def snk2(spark, sf_dir):
    return im.readable_names(universe(spark, sf_dir).select("stock", "month", "close", "market_cap"), {"close": "price", "market_cap": "cap"})
