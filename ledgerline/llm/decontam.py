"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, then banded alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import _LOWER, mix, powers, slices, text_buffers

_P = 0x100000001B3
BENCH_BYTES = 2 << 20  # benchmark bytes that one pass holds (24 bytes of index for each); a larger benchmark takes several passes


def normalize(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A-Z lower-cased, each run of white space one space: bytes, row offsets, and where each byte stood."""
    low = _LOWER[data]
    space = (low == 32) | ((low > 8) & (low < 14))
    keep = np.ones(len(low), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[inner] = True
    at = np.flatnonzero(keep)
    out = np.where(space[at], np.uint8(32), low[at])
    return out, np.searchsorted(at, offsets), at


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q bytes from each place on."""
    n = len(data)
    if n < q:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_P, n), out=total[1:])
    inverse = powers(pow(_P, -1, 1 << 64), n)
    return mix((total[q:] - total[:-q]) * inverse[: n - q + 1])


def banded_distance(item: np.ndarray, text: np.ndarray, budget: int) -> tuple[int, int]:
    """Least edit distance of the item to a stretch of `text` that starts in its first 3 * budget + 3 places, and where
    that stretch ends; budget + 1 if it is more. Only cells within `budget` of these diagonals are worked out."""
    m, width, inside = len(item), 5 * budget + 4, len(text)
    far = budget + 1
    pad = np.concatenate([np.zeros(budget + 1, np.uint8), text, np.zeros(m + width + 1, np.uint8)])
    step = np.arange(width)
    ends = step - budget  # column j: the stretch ends at place i + j - budget
    row = np.where((ends < 0) | (ends > inside), far, 0)  # a free start at row 0
    for i in range(1, m + 1):
        ends = ends + 1
        now = row + (pad[i : i + width] != item[i - 1])  # from (i - 1, same diagonal)
        now[:-1] = np.minimum(now[:-1], row[1:] + 1)  # a letter of the item is missing in the text
        now[(ends < 0) | (ends > inside)] = far
        row = np.minimum(np.minimum.accumulate(now - step) + step, far)  # letters of the text that the item lacks
        row[ends > inside] = far
        if row.min() >= far:
            return far, 0
    best = int(row.argmin())
    return int(row[best]), m + best - budget


class _Items:
    """Benchmark items of one q with the places of their q-grams, sorted by hash."""

    def __init__(self, ids: list[int], items: list[np.ndarray], q: int, rate: float):
        self.q, self.ids, self.items = q, ids, items
        hashes = [gram_hashes(x, q) for x in items]
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        self.h = h[order]
        self.item = np.repeat(np.arange(len(items)), [len(x) for x in hashes])[order]
        self.place = np.concatenate([np.arange(len(x)) for x in hashes])[order]
        self.bits = np.zeros(1 << 24, bool)  # a first, quick test by 24 bits of the hash
        self.bits[(self.h >> np.uint64(40)).astype(np.int64)] = True
        self.size = np.array([len(x) for x in items], np.int64)
        # The lemma: within k edits at least m - q + 1 - k * q q-grams are shared; `gram_size` sees that it is one at least.
        self.budget = (self.size * rate).astype(np.int64)
        self.least = self.size - q + 1 - self.budget * q


def gram_size(size: int, q: int, rate: float) -> int:
    """The largest q-gram, up to q, of which an item of so many bytes shares one at least within its budget."""
    return min(q, size // (int(size * rate) + 1))


def build_items(ids: list[int], texts: list[str], q: int, rate: float) -> tuple[list[_Items], dict[bytes, list[int]]]:
    """Items in groups of one q-gram size (6 or `q`), and short ones, which match exactly and as whole words."""
    groups: dict[int, tuple[list, list]] = {}
    short: dict[bytes, list[int]] = {}
    for i, t in zip(ids, texts, strict=True):
        raw = np.frombuffer(t.encode(), np.uint8)
        data = normalize(raw, np.array([0, len(raw)]))[0]
        data = np.frombuffer(data.tobytes().strip(b" "), np.uint8)
        own = gram_size(len(data), q, rate)
        if len(data) >= q and own >= min(6, q):
            group = groups.setdefault(q if own == q else min(6, q), ([], []))
            group[0].append(i)
            group[1].append(data)
        elif len(data):
            short.setdefault(data.tobytes(), []).append(i)
    return [_Items(*g, size, rate) for size, g in groups.items()], short


def _short_matches(short: dict[bytes, list[int]], data: np.ndarray, offsets: np.ndarray):
    """(row, item id, begin, end, 0): the first place of each short item in a row, between spaces or the row's ends."""
    by_size: dict[int, dict[int, list[bytes]]] = {}
    for item in short:
        h = int(gram_hashes(np.frombuffer(item, np.uint8), len(item))[0])
        by_size.setdefault(len(item), {}).setdefault(h, []).append(item)
    row_of = np.zeros(len(data) + 1, bool)
    row_of[offsets] = True
    begins = row_of[: len(data)] | np.r_[True, data[:-1] == 32][: len(data)]
    ends = row_of[1:] | np.r_[data[1:] == 32, True][: len(data)]
    for size, items in by_size.items():
        h = gram_hashes(data, size)
        at = np.flatnonzero(begins[: len(h)] & ends[size - 1 :]) if len(h) else np.zeros(0, np.int64)
        at = at[np.isin(h[at], np.fromiter(items, np.uint64, len(items)))]
        row = np.searchsorted(offsets, at, "right") - 1
        seen = set()
        for r, k in zip(row.tolist(), at.tolist(), strict=True):
            own = data[k : k + size].tobytes()
            if k + size <= offsets[r + 1] and (r, own) not in seen and own in short:
                seen.add((r, own))
                for i in short[own]:
                    yield r, i, k, k + size, 0


def _matches(items: _Items, data: np.ndarray, offsets: np.ndarray):
    """(row, item, begin, end, edits) in normalised bytes, at most the best one of a row and item."""
    q = items.q
    h = gram_hashes(data, q)
    at = np.flatnonzero(items.bits[(h >> np.uint64(40)).astype(np.int64)]) if len(h) else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, at, "right") - 1
    keep = at + q <= offsets[row + 1] if len(at) else np.zeros(0, bool)
    at, row = at[keep], row[keep]
    lo, hi = np.searchsorted(items.h, h[at], "left"), np.searchsorted(items.h, h[at], "right")
    n = hi - lo
    src = np.repeat(np.arange(len(at)), n)
    if not len(src):
        return
    ref = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    item, where, row = items.item[ref], at[src], row[src]
    # Diagonals fall in bands of twice the budget's width that overlap by half, so no set of shared q-grams is parted.
    diagonal = where - items.place[ref] + (1 << 20)
    width = items.budget[item] + 1
    found = []
    for shift in (0, 1):
        band = (diagonal + shift * width) // (2 * width) * 2 - shift
        key = np.stack([row, item, band], 1)
        order = np.lexsort((where, band, item, row))
        key = key[order]
        new = np.r_[True, (key[1:] != key[:-1]).any(1)]
        begin = np.flatnonzero(new)
        count = np.diff(np.r_[begin, len(key)])
        good = count >= items.least[key[begin, 1]]
        found += [(int(r), int(i), int(b)) for r, i, b in key[begin[good]]]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for r, i, b in sorted(set(found)):
        if best.get((r, i), (1,))[0] == 0:
            continue
        k, w, m = int(items.budget[i]), int(items.budget[i]) + 1, int(items.size[i])
        start = b * w - (1 << 20)
        lo = max(int(offsets[r]), start - k)
        hi = min(int(offsets[r + 1]), start + 2 * w + m + k)
        part = data[lo:hi]
        place = part.tobytes().find(items.items[i].tobytes())
        if place >= 0:
            best[(r, i)] = (0, lo + place, lo + place + m)
            continue
        edits, end = banded_distance(items.items[i], part, k)
        if edits <= k and edits < best.get((r, i), (k + 1,))[0]:
            best[(r, i)] = (edits, lo + max(0, end - m), lo + end)
    for (r, i), (edits, lo, hi) in best.items():
        yield r, i, lo, hi, edits


def benchmark_parts(benchmark: DataFrame, most: int) -> list[DataFrame]:
    """Distinct (item_id, text) of the benchmark in parts of at most `most` bytes: fine buckets by hash, joined as long as
    their running sum stays below. A bucket is an eighth of that on average; only an item above `most` makes a larger part."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("trim(text) <> ''").distinct()
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-8 * total // most)) if total > most else 1
    b = b.withColumn("bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets)))
    parts, held = [[]], 0
    for r in b.groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("n")).orderBy("bucket").collect():
        if parts[-1] and held + r["n"] > most:
            parts.append([])
            held = 0
        parts[-1].append(r["bucket"])
        held += r["n"]
    return [b.where(F.col("bucket").between(p[0], p[-1])).drop("bucket") if p else b.limit(0).drop("bucket") for p in parts]


def contamination(docs: DataFrame, benchmark: DataFrame, q: int = 10, rate: float = 0.08, most: int = BENCH_BYTES) -> DataFrame:
    """(doc_id, item_id, begin, end, edits, text_hash): benchmark items that stand in a text within an edit budget.

    Both sides are lower-cased (A-Z) with white space runs as one space; begin and end are byte places in the
    document so normalised. The budget is `rate` of the item's bytes, rounded down. Items under `q` bytes, or
    too short to share a q-gram of 6 bytes at that budget (none at this rate), match exactly, as whole words; null and empty items and null texts match nothing. One best
    place is given for a row and item; repeated rows give repeated matches, repeated items one. Without items or texts
    there are no rows. Very long texts are searched whole; extra columns are not read. The benchmark is split in parts of at
    most `most` bytes, so what is broadcast is bounded whatever its size; each part is one pass over the documents.
    """
    spark = docs.sparkSession
    out = None
    for part in benchmark_parts(benchmark, most):
        own = part.orderBy("item_id", "text").toArrow()
        held = spark.sparkContext.broadcast((own["item_id"].to_pylist(), own["text"].to_pylist()))

        def search(batches, held=held):
            groups, short = build_items(*held.value, q, rate)
            for batch in batches:
                data, offsets = text_buffers(batch.column(1))
                cols: list[list] = [[], [], [], [], []]
                for lo, hi in slices(offsets):
                    own, at, _ = normalize(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    found = [(r, g.ids[i], *more) for g in groups for r, i, *more in _matches(g, own, at)]
                    found += _short_matches(short, own, at) if short else []
                    for r, i, begin, end, edits in found:
                        for c, v in zip(cols, (lo + r, i, begin - int(at[r]), end - int(at[r]), edits), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:]], batch.column(2).take(pa.array(cols[0], pa.int64()))], ["doc_id", "item_id", "begin", "end", "edits", "text_hash"])

        got = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(search, "doc_id long, item_id long, begin long, end long, edits long, text_hash long")
        out = got if out is None else out.union(got)
    return out
