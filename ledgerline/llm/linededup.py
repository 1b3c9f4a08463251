"""Line dedup by content-defined chunks of lines, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE, broadcast_if_small, materialize, release, row_keys

ROW = ("_d", "_t")  # what names a document


def repeated_keys(docs: DataFrame, long_words: int = 50) -> DataFrame:
    """(_d, _t, i, key, link, c): of each document, the keys that stand c >= 2 times in the corpus.

    A key is the rolling hash over the hashes of lines i and i + 1 (link), or the hash of line i alone if it has
    `long_words` words or more. Keys are counted in partitions before the shuffle; the join that hands the counts back is
    written as it is, so Spark can split a hot key's partition.
    """
    let = lambda value, body: F.transform(F.array(value), body)[0]
    is_long = lambda x: (F.length(x) >= 2 * long_words - 1) & (F.size(F.filter(F.split(x, SPACE + "+"), lambda w: w != "")) >= long_words)
    row = lambda i, key, link: F.struct(i.cast("int").alias("i"), key.alias("key"), F.lit(link).alias("link"))
    links = lambda h: F.transform(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, i: row(i + 1, F.xxhash64(x, F.get(h, i + 1)), True))
    alone = F.filter(F.transform("_lines", lambda x, i: F.when(is_long(x), row(i + 1, F.xxhash64(x), False))), lambda r: r.isNotNull())
    lines = docs.where("text is not null").select(*ROW, F.split("text", "\n", -1).alias("_lines"))
    both = F.concat(let(F.transform("_lines", lambda x: F.xxhash64(x)), links), alone)
    keys = materialize(lines.select(*ROW, F.explode(both).alias("k")).select(*ROW, "k.*"))
    counts = materialize(keys.groupBy("key", "link").agg(F.count("*").alias("c")).where("c > 1"))
    found = materialize(keys.join(counts, ["key", "link"]).select(*ROW, "i", "key", "link", "c"))
    release(keys, counts)
    return found


def line_chunks(found: DataFrame) -> DataFrame:
    """(_d, _t, start, n, h): chunks of n >= 2 lines from repeated links, and long repeated lines (n = 1), start from 1.

    Lines whose links all repeat form one run. A run is cut at a link that is rarer than the one before or after it, so
    passages that meet in a text are parted, and where the rolling hash is a local minimum among links of one count.
    Both depend on the neighbouring lines only, so a passage is cut alike wherever it stands. Two minima are never adjacent.
    """
    order = Window.partitionBy(*ROW).orderBy("i")
    found = found.repartition(*ROW)
    links = found.where("link").distinct().withColumns({"p": F.lag(F.struct("i", "c", "key")).over(order), "q": F.lead(F.struct("i", "c", "key")).over(order)})
    links = links.withColumns({"after": F.expr("coalesce(p.i = i - 1, false)"), "before": F.expr("coalesce(q.i = i + 1, false)")})
    links = links.withColumn("weak", F.expr("(after and c < p.c) or (before and c < q.c)"))
    calm = "after and before and not weak and not coalesce(pw, false) and not coalesce(qw, false) and c = p.c and c = q.c"
    links = links.withColumns({"pw": F.lag("weak").over(order), "qw": F.lead("weak").over(order)})
    links = links.where(f"not weak and not ({calm} and key < p.key and key <= q.key)").withColumn("run", F.col("i") - F.row_number().over(order))
    keys = F.transform(F.sort_array(F.collect_list(F.struct("i", "key"))), lambda x: x["key"])
    chunks = links.groupBy(*ROW, "run").agg(F.min("i").alias("start"), (F.count("*") + 1).cast("int").alias("n"), F.xxhash64(keys).alias("h"))
    return chunks.select(*ROW, "start", "n", "h").union(found.where("not link").select(*ROW, "i", F.lit(1), "key"))


def dedup_lines(docs: DataFrame, long_words: int = 50) -> DataFrame:
    """Remove repeated chunks of lines that stand elsewhere before: all columns of `docs` with the cleaned text, and
    `removed_lines`.

    A chunk has two lines with a word or more, or `long_words` words in one line. Of each chunk, the first occurrence
    (smallest doc_id, then smallest text hash, then first in the text) stays; every other one goes if its bytes are
    equal to the first one's. The first place of a line is never in a chunk that goes. Rows with equal doc_id and text
    are one document and are cleaned alike. Null text stays null; a text may become empty; no rows give none. Very long texts
    are cut like others. Only hashes and places are grouped over the corpus (counted in partitions first, so a line in a
    third of all documents costs a row for each task); texts move only for chunks that repeat. All columns of the caller
    pass through under their names, a `removed_lines` of the caller's as `input_removed_lines`.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("_row"), "doc_id", "text").withColumns(row_keys())
    texts = packed.select(*ROW, "text")
    found = repeated_keys(texts, long_words)
    chunks = materialize(line_chunks(found))
    first = chunks.groupBy("h").agg(F.min(F.struct(*ROW, "start")).alias("f"), F.max(F.struct(*ROW, "start")).alias("l"))
    first = materialize(first.where("f <> l").select("h", "f"))
    # A join of two tables and nothing after it: Spark can split the partition of a chunk that many documents hold.
    repeated = materialize(chunks.join(first, "h").select(*ROW, "start", "n", "h", F.expr("_d = f._d and _t = f._t and start = f.start").alias("first")))
    marks = materialize(repeated.groupBy(*ROW).agg(F.collect_set(F.struct("start", "n", "h", "first")).alias("marks")))
    release(found, chunks, first, repeated)
    told = texts.where("text is not null").join(broadcast_if_small(marks), list(ROW))
    told = told.select(*ROW, F.split("text", "\n", -1).alias("_lines"), F.explode("marks").alias("m")).select(*ROW, "m.*", F.slice("_lines", F.col("m.start"), F.col("m.n")).alias("part"))
    worded = F.size(F.filter("part", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))) >= 2
    told = materialize(told.where((F.col("n") == 1) | worded).select(*ROW, "start", "n", "h", "first", F.array_join("part", "\n").alias("chunk")))
    kept = materialize(told.where("first").groupBy("h").agg(F.min("chunk").alias("kept")))
    equal = materialize(told.where("not first").join(kept, "h").where("chunk = kept").select(*ROW, "start", "n"))
    gone = materialize(equal.groupBy(*ROW).agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("n") - 1)))).alias("_gone")))
    release(marks, told, kept, equal)
    held = packed.select("_row", *ROW).join(broadcast_if_small(gone), list(ROW), "left")
    own = F.col("_row")["text"]
    lines = F.split(own, "\n", -1)
    left = F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), "_gone"), lambda i: F.element_at(F.col("_lines"), i))
    held = held.withColumn("_lines", F.when(F.col("_gone").isNotNull(), lines))
    text = F.when(F.col("_gone").isNull(), own).otherwise(F.array_join(left, "\n"))
    out = [(text if c == "text" else F.col("_row")[c]).alias("input_removed_lines" if c == "removed_lines" else c) for c in names]
    return held.select(*out, F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("removed_lines"))
