"""Sharding by histogram sort: exact byte counts below probes, refined until splitters meet the tolerance, one exchange."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize

#: A sort key is (hash of the text, document, row): 3 x 64 bits, unsigned, compared as 24 bytes.
_FLIP = np.uint64(1 << 63)


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    cols = [np.asarray(batch.column(batch.schema.get_field_index(c)).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), np.int64) for c in ("_h", "_d", "_r")]
    flat = np.stack([c.view(np.uint64) ^ _FLIP for c in cols], axis=1).astype(">u8")
    return np.ascontiguousarray(flat).view("S24").ravel()


def _bytes(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(24, "big") for k in keys], "S24")


def _counts(index: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """For each bucket between probes that holds rows: number, bytes, rows, smallest and largest key."""
    held = index.sparkSession.sparkContext.broadcast(_bytes(probes))

    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _keys(batch)
            order = np.argsort(keys)
            keys, sizes = keys[order], np.asarray(batch.column(batch.schema.get_field_index("_size")))[order]
            bucket = np.searchsorted(held.value, keys, "right")
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            last = np.r_[first[1:], len(keys)]
            pad = lambda k: bytes(k).ljust(24, b"\0")
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), pa.array(np.add.reduceat(sizes, first), pa.int64()), pa.array(last - first, pa.int64()), pa.array([pad(k) for k in keys[first]], pa.binary()), pa.array([pad(k) for k in keys[last - 1]], pa.binary())], ["bucket", "bytes", "rows", "low", "high"])

    found = index.mapInArrow(count, "bucket long, bytes long, rows long, low binary, high binary")
    found = found.groupBy("bucket").agg(F.sum("bytes"), F.sum("rows"), F.min("low"), F.max("high")).orderBy("bucket").collect()
    return [(r[0], r[1], r[2], int.from_bytes(r[3], "big"), int.from_bytes(r[4], "big")) for r in found]


def _spread(lo: int, hi: int, most: int) -> list[int]:
    """Probes in (lo, hi]: whole text groups first, then documents of one group, then rows of one document."""
    for shift in (128, 64, 0):
        a, n = lo >> shift, (hi >> shift) - (lo >> shift)
        if n > 0:
            step = min(n, most)
            return [(a + (n * (k + 1)) // step) << shift for k in range(step)]
    return []


def histogram_splitters(index: DataFrame, shards: int, tolerance: float = 0.005, fanout: int = 128) -> tuple[list[int], list[int]]:
    """Splitters that cut the key order in `shards` parts of equal bytes, and finer boundaries in between.

    Each round counts the exact bytes below all open probes in one pass over the narrow index and keeps, for each
    splitter, the interval that holds its target. A splitter is done when the bytes below it are within `tolerance` of a
    mean shard, or when its interval holds one row only. What comes to the driver is bounded by shards * fanout.
    """
    whole = _counts(index, [])
    if not whole:
        return [0] * (shards - 1), []
    _, total, _, low, high = whole[0]
    mean = total / shards
    state = {k: (low, 0, high + 1, total) for k in range(1, shards)}  # interval and the bytes below its ends
    done: dict[int, int] = {}
    below: dict[int, int] = {}
    while state:
        for k, (lo, w_lo, hi, w_hi) in list(state.items()):
            near, w = min(((lo, w_lo), (hi, w_hi)), key=lambda x: abs(x[1] - mean * k))
            if abs(w - mean * k) <= tolerance * mean or hi - lo <= 1:
                done[k] = near
                del state[k]
        probes = sorted({p for lo, _, hi, _ in state.values() for p in _spread(lo, hi, fanout)})
        if not probes:
            break
        found = {b: (w, lo, hi) for b, w, _, lo, hi in _counts(index, probes)}
        w = 0
        sums = []
        for b in range(len(probes)):
            w += found.get(b, (0, 0, 0))[0]
            sums.append(w)
        below.update(zip(probes, sums, strict=True))
        for k, (lo, w_lo, hi, w_hi) in list(state.items()):
            target = mean * k
            at = bisect_left(sums, target)  # first probe with at least the target below it
            if at < len(probes) and probes[at] <= hi:
                hi, w_hi = probes[at], sums[at]
            if at and probes[at - 1] >= lo:
                lo, w_lo = probes[at - 1], sums[at - 1]
            near, w = min(((lo, w_lo), (hi, w_hi)), key=lambda x: abs(x[1] - target))
            if abs(w - target) <= tolerance * mean:
                done[k] = near
                del state[k]
                continue
            if at in found:  # keys between the two probes
                _, first, last = found[at]
                if first == last:
                    done[k] = first if target - w_lo < w_hi - target else first + 1
                    del state[k]
                    continue
                lo, hi = max(lo, first), min(hi, last + 1)
            state[k] = (lo, w_lo, hi, w_hi)
    splitters = [done[k] for k in range(1, shards)]
    fine, last = [], 0
    for p, w in sorted(below.items()):
        if w - last >= mean / 32:
            fine.append(p)
            last = w
    return splitters, fine


def shard_by_bytes(docs: DataFrame, shards: int = 40, tolerance: float = 0.005) -> DataFrame:
    """Put documents into shards of near equal bytes, equal texts side by side: rows (doc_id, size, text_crc32, law,
    shard, slot, grown_shard).

    The key order is by text hash, then document, then row, so copies are neighbours; a group of copies is kept whole
    where a boundary of the group meets the tolerance and is split where it is too large for that. Size is the text's
    UTF-8 bytes plus 16 (null text: 16, crc of the empty text). Repeated rows are rows of their own. An empty table
    gives no rows. A very long text is one row, which no shard boundary cuts; extra columns are not read. grown_shard is null: the law is by bytes, not by key. Slots are gapless from 0 in each shard, in key order.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    index = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("_size"), F.crc32(text).alias("_crc"), F.xxhash64(text).alias("_h"))
    index = materialize(index.withColumn("_d", F.col("doc_id")).withColumn("_r", F.monotonically_increasing_id()))
    splitters, fine = histogram_splitters(index.select("_h", "_d", "_r", "_size"), shards, tolerance)
    bounds = sorted(set(splitters) | set(fine))
    counts = {b: rows for b, _, rows, _, _ in _counts(index.select("_h", "_d", "_r", "_size"), bounds)}
    shard_of = [sum(s <= (bounds[b - 1] if b else -1) for s in splitters) for b in range(len(bounds) + 1)]
    start, filled = [], dict.fromkeys(range(shards), 0)
    for b, s in enumerate(shard_of):
        start.append(filled[s])
        filled[s] += counts.get(b, 0)
    held = docs.sparkSession.sparkContext.broadcast((_bytes(bounds), np.array(shard_of, np.int32), np.array(start, np.int64)))

    def place(batches):
        for batch in batches:
            edges, shard, begin = held.value
            keys = _keys(batch)
            bucket = np.searchsorted(edges, keys, "right")
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "_size", "_crc")] + [pa.array(bucket, pa.int64()), pa.array([bytes(k).ljust(24, b"\0") for k in keys], pa.binary()), pa.array(shard[bucket]), pa.array(begin[bucket])], ["doc_id", "size", "text_crc32", "bucket", "key", "shard", "begin"])

    placed = index.mapInArrow(place, "doc_id long, size long, text_crc32 long, bucket long, key binary, shard int, begin long")
    order = Window.partitionBy("bucket").orderBy("key")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begin") + F.row_number().over(order) - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
