"""Shared helpers: materialised tables, Arrow text batches, word hashing and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every word definition here: space and \x09 to \x0D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one where it is unset in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors, read by column."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/ledgerline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _hadoop(table: DataFrame):
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more: all that came of them is written itself."""
    for t in tables:
        files, path = _hadoop(t)
        files.delete(path, True)


def is_small(table: DataFrame, most: int = 16 << 20) -> bool:
    """Whether the files of a materialised table have at most so many bytes."""
    files, path = _hadoop(table)
    return files.getContentSummary(path).getLength() <= most


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """A materialised table, marked for broadcast only if its files are small; else Spark joins by shuffle."""
    return F.broadcast(table) if is_small(table) else table


@contextmanager
def arrow_batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of at most so many bytes for the jobs started inside, so that a worker holds a few copies of little."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def row_keys() -> dict[str, Column]:
    """What names a row of documents: doc_id (null: a value of its own) and a hash of the text. Rows equal in both are alike."""
    return {"_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))), "_t": F.xxhash64("text")}


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        offsets = np.zeros(1, np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes (one row at least), so that the arrays over bytes stay small."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end
        row = end


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if len(held) <= 1 << 23:
            _powers[base] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, A-Z lower-cased, and for each row where its words begin (one more entry at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    inside = ~_IS_SPACE[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edge] = inside[edge]
    edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[edge] = inside[edge]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    h = (total[end] - total[begin]) * powers(pow(_BASE, -1, 1 << 64), n)[begin]
    return mix(h), np.searchsorted(begin, offsets)


def shingle_hashes(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of all runs of `width` words; with fewer words, of the whole sequence; none without words."""
    if not len(words):
        return words
    width = min(width, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        h = (h + words[k : len(words) - width + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Components of undirected edges (a, b), both long: rows (node, component), component = smallest node.

    Alternating large-star and small-star steps: each one is a grouped minimum and a join, so that a hub of any
    degree is combined before the shuffle, and the number of rounds is logarithmic in the longest path. Each round is
    written to the shared folder. Nodes without edges are not returned; no edges give no rows.
    """
    stars = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(rounds):
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        old, stars = stars, materialize(small.select("e.a", "e.b").where("a <> b").distinct())
        release(old)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not converge")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(stars.select(F.col("b"), F.col("b")).distinct())
