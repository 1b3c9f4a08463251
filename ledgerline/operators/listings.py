"""Selection of listings and checks of static data: screens on names, codes, domicile and currency, set comparisons, reports.

Pattern tables (country, pattern, overridable) and country tables are small parameters, given as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import two_digit_year
from ledgerline.functions.frames import by, first_rows

# Security-type codes of common stock, what counts as missing, and the status words that end a name.
COMMON_CODES = ("ORD", "ORDSUBR", "FULLPAID", "UKNOWN", "UNKNOW", "KNOW")
MISSING = ("", "NA", "#NA", "#N/A", "N/A", "NAN", "NONE", "NULL")
STATUS = r"\s+(DEAD|DELIST\.|SUSP|SUSPENDED|EXPIRED|DUPL|DUPLICATE|MERGER|TAKEN OVER)\b.*$"


def known(c: Column) -> Column:
    """The trimmed value, null for the tokens of missing values."""
    return F.when(~F.upper(F.trim(c)).isin(*MISSING), F.trim(c))


def name_core(name: Column) -> Column:
    """the name without its status words, between blanks."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(name, STATUS, "")), F.lit(" "))


def first_known(*codes: str) -> Column:
    """DER4: the first of several codes that is not missing, as the company's id."""
    return F.coalesce(*[known(F.col(c)) for c in codes])


def common_stocks(statics: DataFrame, patterns: DataFrame, strip_status: bool = True, override: bool = True) -> DataFrame:
    """keep common stocks: code of common stock or none, and no pattern (literal text) of its country in the name.
    Code ORD overrides patterns that may be overridden; a duplicate's status drops the line."""
    code = F.upper(known(F.col("code")))
    s = statics.withColumn("_core", name_core(F.col("ename")) if strip_status else F.concat(F.lit(" "), "ename", F.lit(" ")))
    hits = s.join(patterns, "country").where(F.contains("_core", "pattern"))
    hits = hits.groupBy("stock").agg(F.bool_or(~F.col("overridable")).alias("_strict"), F.lit(True).alias("_hit"))
    s = s.join(hits, "stock", "left")
    pattern_ok = F.col("_hit").isNull() | ((F.lit(override) & (code == "ORD")) & ~F.col("_strict"))
    duplicate = F.col("ename").rlike(r"\bDUPL") if strip_status else F.lit(False)
    return s.where((code.isNull() | code.isin(*COMMON_CODES)) & F.coalesce(pattern_ok, F.lit(False)) & ~duplicate).drop("_core", "_strict", "_hit")


def without_cross_listings(statics: DataFrame, venues: DataFrame) -> DataFrame:
    """drop names that match the pattern (regular expression) of their country's venues; an empty one drops none."""
    bad = statics.join(venues.where("pattern <> ''"), "country").where(F.expr("ename rlike pattern")).select("stock").distinct()
    return statics.join(bad, "stock", "left_anti")


def without_duplicate_codes(statics: DataFrame, *keys: str) -> DataFrame:
    """of lines with an equal code, one of them primary, the others go; for each key in turn. Missing codes are no group."""
    for key in keys:
        w = by("_k")
        s = statics.withColumn("_k", known(F.col(key))).withColumn("_primary", F.coalesce(F.col("isinid") == "P", F.lit(False)))
        twice = F.col("_k").isNotNull() & (F.count("*").over(w) > 1) & F.max("_primary").over(w)
        statics = s.withColumn("_drop", twice & ~F.col("_primary")).where("not _drop").drop("_k", "_primary", "_drop")
    return statics


def domestic(statics: DataFrame, aliases: DataFrame) -> DataFrame:
    """keep lines whose domicile is a name of their country (aliases: country, domicile)."""
    return statics.join(aliases, ["country", "domicile"], "left_semi")


def domestic_currency(statics: DataFrame, currencies: DataFrame) -> DataFrame:
    """keep lines quoted in a currency of their country (currencies: country, currency)."""
    return statics.join(currencies, ["country", "currency"], "left_semi")


def large_countries(statics: DataFrame, least: int = 20) -> DataFrame:
    """keep countries with so many distinct stocks."""
    big = statics.groupBy("country").agg(F.count_distinct("stock").alias("n")).where(F.col("n") >= least)
    return statics.join(big.select("country"), "country", "left_semi")


def delisting_in_name(name: Column) -> Column:
    """FX3: the date after DELIST. in a name."""
    return two_digit_year(F.regexp_extract(name, r"DELIST\.(\d{2}/\d{2}/\d{2})", 1))


def first_country(lines: DataFrame) -> DataFrame:
    """LST4: the lines of all countries as one list; the first country in order wins an id."""
    return first_rows(lines, ["stock"], ["country_order", "country"])


def domestic_listings(lines: DataFrame, venues: DataFrame) -> DataFrame:
    """LST1: equities on their country's exchanges, each id once."""
    ok = lines.where("category = 'Equities'").join(venues, "country").where(F.expr("exchange rlike concat('(?i)', pattern)"))
    return first_country(ok.drop("pattern"))


def _top(lines: DataFrame, keys: list[str], column: str, top: int) -> DataFrame:
    """The most frequent known values of a column in each group, joined; equally frequent ones by value."""
    g = lines.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    g = g.withColumn("_r", F.row_number().over(by(*keys, order=[F.desc("_n"), column]))).where(F.col("_r") <= top)
    return g.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", column))), lambda x: x[column]), "; ").alias(column))


def marked_lines(lines: DataFrame, venues: DataFrame) -> DataFrame:
    """Lines with `domestic`: their exchange fits the pattern of their country; the pattern ^$ fits none, a country without one is null."""
    fits = F.when(F.col("pattern") == "^$", F.lit(False)).otherwise(F.coalesce(F.expr("exchange rlike concat('(?i)', pattern)"), F.lit(False)))
    return lines.join(venues, "country", "left").withColumn("domestic", F.when(F.col("pattern").isNotNull(), fits)).drop("pattern")


def exchange_report(lines: DataFrame, venues: DataFrame, top: int = 3) -> DataFrame:
    """LST2: for each country and exchange (null is one of its own): lines, active ones, whether domestic, the most frequent suffixes of
    the trading codes (`ric`, before a `^`) and currencies, and the share of the country's lines."""
    x = marked_lines(lines, venues).withColumn("exchange", F.coalesce("exchange", F.lit("")))
    x = x.withColumn("suffixes", F.nullif(F.regexp_extract(F.substring_index("ric", "^", 1), r"\.([A-Za-z]+)$", 1), F.lit("")))
    keys = ["country", "exchange"]
    e = x.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("active")).alias("active"), F.bool_and("domestic").alias("domestic"))
    e = e.join(_top(x, keys, "suffixes", top), keys, "left").join(_top(x.withColumnRenamed("currency", "currencies"), keys, "currencies", top), keys, "left")
    return e.withColumn("share", F.round(F.col("n") / F.sum("n").over(by("country")), 3))


def exchange_warnings(lines: DataFrame, venues: DataFrame, countries: DataFrame, unknown_share: float = 0.1) -> DataFrame:
    """LST3: (country, rule, detail) rows of export files. Lines have `file` and the country of each line; a file's country is its most
    frequent one. Rules: a file of several countries; rows that are no equities; no pattern for the country (nothing else is
    looked at then); no domestic line, or else the largest exchange abroad; a large exchange that is domestic nowhere; rows
    without an exchange; ids repeated among the domestic lines; countries without a file."""
    own = first_rows(lines.where("country is not null").groupBy("file", "country").agg(F.count("*").alias("_n")), ["file"], [F.desc("_n"), "country"]).select("file", "country")
    row = lambda rule, detail: [F.lit(rule).alias("rule"), detail.cast("string").alias("detail")]
    several = lines.groupBy("file").agg(F.array_sort(F.collect_set("country")).alias("c")).where("size(c) <> 1").join(own, "file", "left").select("country", *row("several countries", F.array_join("c", "; ")))
    x = lines.drop("country").join(own, "file")
    other = x.where("category <> 'Equities' or category is null").groupBy("country").agg(F.count("*").alias("n")).select("country", *row("no equities", F.col("n")))
    x = x.where("category = 'Equities'")
    without = own.join(venues, "country", "left_anti").select("country", *row("no pattern", F.lit("")))
    x = marked_lines(x, venues).where("domestic is not null")
    e = x.groupBy("country", F.coalesce("exchange", F.lit("")).alias("exchange")).agg(F.count("*").alias("n"), F.bool_and("domestic").alias("domestic"))
    e = e.withColumn("share", F.round(F.col("n") / F.sum("n").over(by("country")), 3))
    none = e.groupBy("country").agg(F.bool_or("domestic").alias("d")).where("not d").select("country", *row("no domestic line", F.lit("")))
    abroad = first_rows(e, ["country"], [F.desc("n"), "exchange"]).where("not domestic").join(none, "country", "left_anti").select("country", *row("largest exchange abroad", F.col("exchange")))
    large = e.where((F.col("share") >= unknown_share) & ~F.col("domestic"))
    elsewhere = venues.where("pattern <> '^$'").select(F.col("country").alias("_c"), "pattern")
    large = large.join(elsewhere, F.expr("_c <> country and exchange rlike concat('(?i)', pattern)"), "left_anti").select("country", *row("large unknown exchange", F.col("exchange")))
    unnamed = x.where("coalesce(exchange, '-') in ('-', '')").groupBy("country").agg(F.count("*").alias("n")).select("country", *row("no exchange name", F.col("n")))
    twice = x.where("domestic").groupBy("country").agg((F.count("*") - F.count_distinct("stock")).alias("n")).where("n > 0").select("country", *row("repeated ids", F.col("n")))
    missing = countries.select("country").join(own, "country", "left_anti").select("country", *row("no file", F.lit("")))
    out = several
    for d in (other, without, none, abroad, large, unnamed, twice, missing):
        out = out.unionByName(d)
    return out


def batches(ids: DataFrame, size: int, prefix: str, digits: int = 3) -> DataFrame:
    """LST5: distinct ids (any text) in lists of `size`, in order of their first place `at` in the input (ids with
    one place: by text). The rank of an id is its rank in its band of places and the ids of the bands before, so no task orders them all."""
    code = F.trim(F.col("stock").cast("string"))
    d = ids.select(code.alias("stock"), "at").where("stock <> ''").groupBy("stock").agg(F.min("at").alias("at")).withColumn("_band", F.floor(F.col("at") / (100 * size)))
    sizes = d.groupBy("_band").agg(F.count("*").alias("_n")).withColumn("_one", F.lit(1))
    begin = sizes.select("_band", (F.sum("_n").over(by("_one", order="_band")) - F.col("_n")).alias("_begin"))
    place = F.col("_begin") + F.row_number().over(by("_band", order=["at", "stock"])) - 1
    out = d.join(begin, "_band").withColumn("_at", place)
    number = (F.floor(F.col("_at") / size) + 1).cast("string")
    return out.select("stock", F.concat(F.lit(f"L#{prefix}"), F.when(F.length(number) < digits, F.lpad(number, digits, "0")).otherwise(number)).alias("list"), (F.col("_at") % size + 1).alias("row"))


def normal_id(c: Column) -> Column:
    """STC1: trimmed, without `.0`, digits padded to six."""
    plain = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(plain.rlike(r"^\d{1,5}$"), F.lpad(plain, 6, "0")).otherwise(plain)


def unresolved(statics: DataFrame, fields: list[str]) -> DataFrame:
    """STC2: rows in which every other field is empty or an error token."""
    bad = F.forall(F.array(*[F.col(c).cast("string") for c in fields]), lambda x: x.isNull() | (F.trim(x) == "") | F.startswith(x, F.lit("$$ER")) | F.upper(F.trim(x)).isin(*MISSING))
    return statics.where(bad)


def compare_sets(expected: DataFrame, found: DataFrame) -> DataFrame:
    """STC3: counts of ids in both, missing, unexpected, found more than once, in several lists; and of the expected ids that a
    spreadsheet may read as numbers (`1234E5`), all and missing."""
    e = expected.groupBy("stock").agg(F.count("*").alias("e"))
    f = found.groupBy("stock").agg(F.count("*").alias("f"))
    risky = F.col("e").isNotNull() & F.col("stock").cast("string").rlike(r"(?i)^\d+E\d+$")
    return e.join(f, "stock", "full").agg(
        F.count_if(F.expr("e is not null and f is not null")).alias("both"), F.count_if(F.col("f").isNull()).alias("missing"), F.count_if(F.col("e").isNull()).alias("unexpected"), F.count_if(F.col("f") > 1).alias("duplicated"),
        F.count_if(F.col("e") > 1).alias("in_several_lists"), F.count_if(risky).alias("risky"), F.count_if(risky & F.col("f").isNull()).alias("risky_missing"),
    )


def missing_by_list(expected: DataFrame, found: DataFrame) -> DataFrame:
    """STC3: for each list: its ids, and those not found."""
    e = expected.join(found.select("stock").distinct().withColumn("_f", F.lit(True)), "stock", "left")
    return e.groupBy("list").agg(F.count("*").alias("n"), F.count_if(F.col("_f").isNull()).alias("missing"))


def best_list(lists: DataFrame, folders: DataFrame, least: float = 0.9) -> DataFrame:
    """STC4: overlap of each folder with its list, and the list that fits best where it is under `least`."""
    total = folders.groupBy("folder").agg(F.count("*").alias("total"))
    g = folders.join(lists, "stock").groupBy("folder", "list").agg(F.count("*").alias("n")).join(total, "folder").withColumn("share", F.col("n") / F.col("total"))
    own = g.where("folder = list").select("folder", F.col("share").alias("own_share"))
    best = first_rows(g, ["folder"], [F.desc("n"), "list"]).select("folder", F.col("list").alias("best"))
    out = total.select("folder").join(own, "folder", "left").join(best, "folder", "left").withColumn("own_share", F.coalesce("own_share", F.lit(0.0)))
    return out.withColumn("best", F.when(F.col("own_share") < least, F.col("best")))


def field_coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """STC5: share of filled cells of each field."""
    return df.agg(*[F.avg(known(F.col(c).cast("string")).isNotNull().cast("int")).alias(c) for c in fields]).unpivot([], fields, "field", "filled")


def _same_country() -> Column:
    return F.coalesce(F.upper(F.trim("domicile")) == F.upper(F.trim("country")), F.lit(False))


def domicile_match(statics: DataFrame) -> DataFrame:
    """STC6: share of lines whose domicile is their country, but for case and blanks; a missing domicile is none."""
    return statics.groupBy("country").agg(F.count("*").alias("n"), F.avg(_same_country().cast("int")).alias("matching"))


def domicile_mismatches(statics: DataFrame) -> DataFrame:
    """STC6: the lines whose domicile is not their country."""
    return statics.where(~_same_country())
