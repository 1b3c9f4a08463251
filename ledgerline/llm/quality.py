"""Quality rules: Jensen-Shannon distance of a document's histograms to language references, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE, materialize

# Very common function words of four languages, each counted as a bin of its own.
COMMON_WORDS = (
    "the of and to in a is that for it with as was on are by this be "
    "de la le et les des en un une du que est pour qui dans par sur pas "
    "der die das und von den mit zu sich auf im dem nicht ein eine als auch "
    "el los se las por con no su para al lo del"
).split()
_CODE = 0x30  # the codes of the common words are ASCII characters from here on
# ASCII character classes; white space, symbols and all other characters are bins of their own.
CHAR_CLASSES = ("[a-z]+", "[A-Z]+", "[0-9]+", "[.,;:'-]+")


BASE_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def word_array(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def window_hashes(words: Column, width: int = 5) -> Column:
    """64-bit hashes of all windows of `width` words, in order."""
    n = F.size(words)
    each = F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(width)]))
    return F.when(n >= width, each).otherwise(F.array().cast("array<bigint>"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once, also where lambda functions use it."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column, width: int) -> Column:
    """How many words lie in windows that stand twice or more in the text, the first one included."""

    def twice(pairs):
        same = lambda i, j: F.coalesce(F.get(pairs, i)["h"] == F.get(pairs, j)["h"], F.lit(False))
        marked = F.transform(pairs, lambda p, i: F.when(same(i, i - 1) | same(i, i + 1), p["i"]))
        return F.array_sort(F.filter(marked, lambda x: x.isNotNull()))

    starts = _let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twice)
    # A window adds `width` words, less those that the window before it, in order, has covered.
    first = F.struct(F.lit(-width).cast("int").alias("last"), F.lit(0).cast("int").alias("sum"))
    return F.aggregate(starts, first, lambda s, i: F.struct(i.alias("last"), (s["sum"] + F.least(F.lit(width), i - s["last"])).alias("sum")), lambda s: s["sum"])


def base_counts(docs: DataFrame) -> DataFrame:
    """BASE_COLUMNS for each row, and the text as `_t`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("_t"))
    d = d.withColumn("_w", word_array(F.col("_t")))
    d = d.withColumn("_win", window_hashes(F.col("_w")))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != "")
    d = d.select(
        "doc_id",
        "_t",
        F.size("_w").cast("long").alias("n_words"),
        F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.when(F.size(F.array_distinct("_win")) < F.size("_win"), _covered(F.col("_win"), 5)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _histograms(d: DataFrame) -> DataFrame:
    """Adds `_chars` and `_common`: counts by character class and by common word, the rest as a last bin."""
    n = F.length("_t")
    kept = [n - F.length(F.regexp_replace("_t", c, "")) for c in CHAR_CLASSES]
    # Each common word becomes one character of a short code; a bin counts its character there.
    codes = F.create_map(*[F.lit(x) for i, w in enumerate(COMMON_WORDS) for x in (w, chr(_CODE + i))])
    common = F.filter(F.split(F.lower("_t"), SPACE + "+"), lambda w: w.isin(*COMMON_WORDS))
    d = d.withColumn("_kept", F.array(*kept, n - F.col("word_chars"), F.col("n_symbols"))).withColumn("_code", F.array_join(F.transform(common, lambda w: codes[w]), ""))
    d = d.withColumn("_chars", F.concat("_kept", F.array(F.greatest(F.length("_t") - F.aggregate("_kept", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)))))
    rest = F.greatest(F.col("n_words") - F.length("_code"), F.lit(0))
    count = [F.length("_code") - F.length(F.replace("_code", F.lit(chr(_CODE + i)), F.lit(""))) for i in range(len(COMMON_WORDS))]
    return d.withColumn("_common", F.array(*count, rest).cast("array<int>"))


def _share(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return _let(F.greatest(total, F.lit(1.0)), lambda t: F.transform(counts, lambda x: x / t))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two share arrays."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    return F.sqrt(F.greatest(F.aggregate(F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2), F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def quality_rules(docs: DataFrame, char_limit: float = 0.14, word_limit: float = 0.23, certain: float = 0.3, min_words: int = 20) -> DataFrame:
    """Verdicts on every whole text: base counts, distances to the nearest language
    reference, kept, and text_hash, which with doc_id names the row.

    A reference is the mean share of each bin over all documents of one language with at least `min_words` words (rows
    with a `lang`; one grouped mean over the corpus, one row a language reaches the driver). A document is held against all
    references and the least distance counts, so a wrong or missing `lang` does no harm. A text goes if both histograms
    are far from every reference, or if its characters are beyond `certain`. Distances are only judged from `min_words` words on; shorter documents stand or fall by the base rules. Null text has no words and
    fails. Repeated rows are judged alike; an empty table, or one without any `lang`, sets no distance limit.
    Very long texts are counted whole; extra columns are not read.
    """
    keep = [c for c in BASE_COLUMNS if c != "doc_id"]
    d = docs.select(F.struct("doc_id", "lang", F.xxhash64("text").alias("text_hash")).alias("doc_id"), "text")
    d = _histograms(base_counts(d)).select("doc_id.*", *keep, "_chars", "_common")
    d = materialize(d)
    width_c, width_w = len(CHAR_CLASSES) + 3, len(COMMON_WORDS) + 1
    rb = d.where(F.col("lang").isNotNull() & (F.col("n_words") >= min_words)).select("lang", _share(F.col("_chars")).alias("c"), _share(F.col("_common")).alias("w"))
    sums = rb.groupBy("lang").agg(*[F.avg(F.col("c")[i]).alias(f"c{i}") for i in range(width_c)], *[F.avg(F.col("w")[i]).alias(f"w{i}") for i in range(width_w)])
    refs = sums.orderBy("lang").collect()
    lit = lambda row, k, n: F.array(*[F.lit(float(row[f"{k}{i}"])) for i in range(n)])
    d = d.withColumn("_pc", _share(F.col("_chars"))).withColumn("_pw", _share(F.col("_common")))
    if refs:
        least = lambda xs: F.array_min(F.array(*xs))
        d = d.withColumn("char_distance", least([js_distance(F.col("_pc"), lit(x, "c", width_c)) for x in refs])).withColumn("word_distance", least([js_distance(F.col("_pw"), lit(x, "w", width_w)) for x in refs]))
    else:
        d = d.withColumn("char_distance", F.lit(0.0)).withColumn("word_distance", F.lit(0.0))
    # A short text strays from any reference by chance: the allowance falls with the root of its length.
    limit = F.lit(char_limit) + 0.8 / F.sqrt(F.col("word_chars") + 1)
    far = (F.col("n_words") >= min_words) & (((F.col("char_distance") > limit) & (F.col("word_distance") > word_limit)) | (F.col("char_distance") > certain))
    return d.select(*BASE_COLUMNS, (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance", "text_hash")
