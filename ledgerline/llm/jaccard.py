"""N-gram Jaccard join: prefix buckets, signature trees in each bucket, exact verification, linked classes.

Two texts link when 100 * common >= 80 * union over their distinct five-word shingles. Equal sets are one node (named by a
64-bit digest of the set), so copies cost nothing after the first pass. Any two linked sets share one of the first
n - ceil(0.8 n) + 1 shingles of any fixed order (prefix filter), so buckets by these shingles hold every link. Within
a bucket, a signature tree is walked against itself and prunes node pairs by the largest overlap that their OR-combined
bitmaps and size ranges allow. What is left is verified on the whole sets. Links inside a class that the leaders joined are counted on whole sets, block by block,
without a row for each pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_batch_bytes, connected_components, materialize, mix, release, shingle_hashes, slices, text_buffers, word_hashes

BUCKET = 256  # members of a bucket that one block holds
LEADERS = 16  # sets of one bucket that the others first meet
MEETS = 8  # leaders that one set may meet, over all its buckets: the best first, others only if they are of another class
BETWEEN = 2  # meetings of two classes
CLOSEST = 2  # meetings of a class in one block of a bucket, before all that are left meet
ROUNDS = 4  # of these; more rounds change the work, never the links
HOT = 4096  # sets of a bucket that meet one leader and one sort
BANDS = 1.119  # size bands: linked sets have sizes within 1.25, two bands apart at most, as 1.119 ** 2 > 1.25
BATCH_BYTES = 8 << 20  # bytes of one Arrow batch: texts, buckets or packed sets
SALTS = 16  # parts of a class whose members meet its count
SAMPLED = 64  # one set in so many is counted over all partitions
MEMBERS, SHINGLES = 1024, 1 << 18  # sets, and shingles in all, that one block of a class holds


def size_band(n: str) -> Column:
    return F.floor(F.log(n) / np.log(BANDS))


def _sets(column: pa.Array):
    """Distinct shingle hashes, sorted, of each row of a text column."""
    data, offsets = text_buffers(column)
    for lo, hi in slices(offsets):
        words, at = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        for k in range(hi - lo):
            yield np.unique(shingle_hashes(words[at[k] : at[k + 1]]))


def _digest(s: np.ndarray) -> int:
    if not len(s):
        return 0
    total = int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(s)
    return (total & ((1 << 64) - 1)) - (1 << 63)


def _bitmap(s: np.ndarray) -> bytes:
    """One bit for each shingle, in a power of two of bits: eight times the shingles at least, of larger sets (from 2048 bits
    on) twice. Its halves OR to half the bits."""
    bits = max(64, min(2048, 1 << int(8 * len(s) - 1).bit_length()), 1 << int(2 * len(s) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(mix(s) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def _fold(m: np.ndarray, words: int) -> np.ndarray:
    while m.shape[-1] > words:
        half = m.shape[-1] // 2
        m = m[..., :half] | m[..., half:]
    return m


def shingle_index(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sid, bits, t): size, digest and bitmap of each row's shingle set; and rows (null, -count, shingle, null, t)
    for shingles that stand in the prefixes of many documents of one partition (t null), or of the sets whose digest falls in
    a sample of one in SAMPLED (t 1). The sample finds shingles that are frequent over all partitions but in none of them."""

    def index(batches):
        many, seen, sampled = [], 0, []
        for batch in batches:
            rows = ([], [], [])
            for s in _sets(batch.column(1)):
                rows[0].append(len(s))
                rows[1].append(_digest(s))
                rows[2].append(_bitmap(s) if len(s) else b"")
                many.append(s[: len(s) // 4 + 2])
                seen += len(many[-1])
                if rows[1][-1] % SAMPLED == 0:
                    sampled.append(many[-1])
            if sum(map(len, sampled)) > 500_000:
                yield _rows(*np.unique(np.concatenate(sampled), return_counts=True), 1)
                sampled = []
            if seen > 500_000:
                many, seen = _counted(many), 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()), batch.column(2)], ["doc_id", "n", "sid", "bits", "t"])
        found = _counted(many)
        if found:
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            yield _rows(keys[counts > 2], counts[counts > 2], None)
        if sampled:
            yield _rows(*np.unique(np.concatenate(sampled), return_counts=True), 1)

    def _rows(keys, counts, t):
        return pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.int64()), pa.array(-counts.astype(np.int32)), pa.array(keys.view(np.int64)), pa.nulls(len(keys), pa.binary()), pa.array([t] * len(keys), pa.int64())], ["doc_id", "n", "sid", "bits", "t"])

    def _counted(many):
        if not many:
            return []
        keys, counts = np.unique(np.concatenate(many), return_counts=True)
        return [np.repeat(keys[counts > 1], counts[counts > 1])]  # only an order depends on it: lone ones may go

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(index, "doc_id long, n int, sid long, bits binary, t long")


def prefix_postings(docs: DataFrame, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(key, mark, sid, n): the prefix shingles of each set, shingles of `common` (sorted, with their counts) last in order,
    else by hash. A key that stands in many prefixes falls in parts (mark div 2 is 1, 2, ...) of about HOT sets; other keys
    have part 0. Odd marks: the key is among the first n - ceil(8 n / 9) + 1, one of which every linked set of the same
    size or more has in its own prefix."""
    held = docs.sparkSession.sparkContext.broadcast((common, np.where(counts > HOT, -(-counts // HOT), 0)))

    def emit(batches):
        (often, split), seen = held.value, set()
        for batch in batches:
            parts, held_keys = [], 0
            for s in _sets(batch.column(0)):
                sid = _digest(s)
                if not len(s) or sid in seen:
                    continue
                seen.add(sid)
                own, salt = s, np.zeros(len(s), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    hit = often[at] == s
                    salt = np.where(hit & (split[at] > 0), 1 + sid % np.maximum(split[at], 1), 0)
                    order = np.argsort(hit, kind="stable")
                    own, salt = s[order], salt[order]
                keep, short = len(s) - -(-80 * len(s) // 100) + 1, len(s) - -(-8 * len(s) // 9) + 1
                parts.append((own[:keep].view(np.int64), (2 * salt[:keep] + (np.arange(keep) < short)).astype(np.int32), np.full(keep, sid, np.int64), np.full(keep, len(s), np.int32)))
                held_keys += keep
                if held_keys > 200_000:
                    yield _batch(parts)
                    parts, held_keys = [], 0
            if parts:
                yield _batch(parts)

    def _batch(parts):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], ["key", "mark", "sid", "n"])

    return docs.select("text").mapInArrow(emit, "key long, mark int, sid long, n int")


class _Node:
    __slots__ = ("rows", "kids", "bits", "low", "high", "extra", "label")

    def __init__(self, rows, kids, bits, low, high, extra, label):
        self.rows, self.kids, self.bits, self.low, self.high, self.extra, self.label = rows, kids, bits, low, high, extra, label


def _tree(n: np.ndarray, label: np.ndarray, bits: list[np.ndarray], leaf: int = 16, fan: int = 4) -> _Node:
    """A signature tree over members sorted by size: OR-combined bitmaps, size ranges, the label if all share one."""
    level = []
    for k in range(0, len(n), leaf):
        rows = np.arange(k, min(len(n), k + leaf))
        words = min(len(bits[r]) for r in rows)
        own = np.stack([_fold(bits[r], words) for r in rows])
        extra = int((n[rows] - np.bitwise_count(own).sum(1)).max())
        level.append(_Node(rows, None, own, int(n[rows].min()), int(n[rows].max()), extra, label[rows[0]] if (label[rows] == label[rows[0]]).all() else None))
    while len(level) > 1:
        up = []
        for k in range(0, len(level), fan):
            kids = level[k : k + fan]
            words = min(x.bits.shape[-1] for x in kids)
            own = np.bitwise_or.reduce(np.stack([np.bitwise_or.reduce(np.atleast_2d(_fold(x.bits, words)), 0) for x in kids]), 0)
            label_ = kids[0].label if all(x.label is not None and x.label == kids[0].label for x in kids) else None
            extra = max(x.high for x in kids) if words < max(x.bits.shape[-1] for x in kids) else max(x.extra for x in kids)
            up.append(_Node(None, kids, own, min(x.low for x in kids), max(x.high for x in kids), extra, label_))
        level = up
    return level[0]


def _may_meet(x: _Node, y: _Node) -> bool:
    if x.label is not None and x.label == y.label:
        return False
    if 100 * min(x.high, y.high) < 80 * max(x.low, y.low):
        return False
    if x is y and x.kids is None:
        return True
    words = min(x.bits.shape[-1], y.bits.shape[-1])
    a, b = (np.bitwise_or.reduce(np.atleast_2d(_fold(v.bits, words)), 0) for v in (x, y))
    # Common shingles fall on common bits; a set may hold more shingles than bits by `extra`, or by all when folded.
    most = int(np.bitwise_count(a & b).sum())
    spare = min((v.extra if v.bits.shape[-1] == words else v.high) for v in (x, y))
    return 180 * (most + spare) >= 80 * (x.low + y.low)


def dual_traverse(x: _Node, y: _Node, same: bool, n: tuple, label: tuple, bounds: list | None = None) -> list[tuple[int, int]]:
    """Pairs (row of x, row of y) of different labels that sizes and bitmaps let link; x with itself if `same`. `bounds` gets the
    largest share of common shingles that each pair may have."""
    found, stack = [], [(x, y)]
    while stack:
        a, b = stack.pop()
        if not _may_meet(a, b):
            continue
        if a.kids is None and b.kids is None:
            words = min(a.bits.shape[-1], b.bits.shape[-1])
            p, q = _fold(a.bits, words), _fold(b.bits, words)
            na, nb = n[0][a.rows][:, None].astype(np.int64), n[1][b.rows][None].astype(np.int64)
            # Each bit that only one side has stands for a shingle that the other lacks.
            lack_a = np.bitwise_count(p[:, None] & ~q[None]).sum(2, dtype=np.int64)
            lack_b = np.bitwise_count(q[None] & ~p[:, None]).sum(2, dtype=np.int64)
            most = np.minimum(na - lack_a, nb - lack_b)
            ok = (180 * most >= 80 * (na + nb)) & (label[0][a.rows][:, None] != label[1][b.rows][None])
            for i, j in np.argwhere(ok):
                r, s = int(a.rows[i]), int(b.rows[j])
                if not same or r < s:
                    found.append((r, s))
                    if bounds is not None:
                        bounds.append(most[i, j] / (na[i, 0] + nb[0, j]))
        elif same and a is b:
            kids = a.kids
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif b.kids is None or (a.kids is not None and a.high - a.low >= b.high - b.low):
            stack += [(k, b) for k in a.kids]
        else:
            stack += [(a, k) for k in b.kids]
    return found


def _members(scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    values = scalar.values
    sid, n, label = (np.asarray(values.field(k)) for k in ("sid", "n", "label"))
    order = np.lexsort((sid, n))
    raw = values.field("bits").to_pylist()
    return sid[order], n[order], label[order], [np.frombuffer(raw[i], np.uint64) for i in order]


def _closest(label: tuple, sid: tuple, bounds: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the `most` best of one of their two labels; equal ones by the other set, so that they agree."""
    place = np.tile(np.arange(len(bounds)), 2)
    both, other = np.r_[label[0], label[1]], np.r_[sid[1], sid[0]]
    order = np.lexsort((other, -np.tile(bounds, 2), both))
    start = np.r_[True, both[order][1:] != both[order][:-1]]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return np.unique(place[order[rank < most]])


def _candidates(df: DataFrame, *sides: str, most: int | None = None) -> DataFrame:
    """Walk the trees of each row's blocks (one block against itself, or two): distinct pairs (a, b); of each label only the
    `most` best of a block, if given."""

    def walk(batches):
        for batch in batches:
            found: set[tuple[int, int]] = set()  # buckets of one batch often hold the same pairs
            cols = [batch.column(batch.schema.get_field_index(s)) for s in sides]
            for r in range(batch.num_rows):
                got = [_members(c[r]) for c in cols]
                trees = [_tree(g[1], g[2], g[3]) for g in got]
                x, y = got[0], got[-1]
                bounds: list | None = None if most is None else []
                met = dual_traverse(trees[0], trees[-1], len(sides) == 1, (x[1], y[1]), (x[2], y[2]), bounds)
                if met and most is not None:
                    i, j = np.array(met).T
                    met = [met[k] for k in _closest((x[2][i], y[2][j]), (x[0][i], y[0][j]), np.array(bounds), most)]
                for i, j in met:
                    p, q = int(x[0][i]), int(y[0][j])
                    found.add((min(p, q), max(p, q)))
            pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return df.select(*sides).mapInArrow(walk, "a long, b long").where("a <> b").distinct()


def _bound(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps let them link."""
    one, two = (sets.select(F.col("sid").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"m{c}")) for c in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b").where("100 * least(na, nb) >= 80 * greatest(na, nb)")

    def test(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            na, nb, ma, mb = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("na", "nb", "ma", "mb"))
            for i in range(batch.num_rows):
                x, y = np.frombuffer(ma[i], np.uint64), np.frombuffer(mb[i], np.uint64)
                words = min(len(x), len(y))
                x, y = _fold(x, words), _fold(y, words)
                most = min(na[i] - int(np.bitwise_count(x & ~y).sum()), nb[i] - int(np.bitwise_count(y & ~x).sum()))
                ok[i] = 180 * most >= 80 * (na[i] + nb[i])
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    return both.mapInArrow(test, "a long, b long")


def _pack(s: np.ndarray, whole: bool) -> bytes:
    """A set as bytes: 64 bits a shingle, or for large sets the steps between the upper halves, by byte planes (they compress)."""
    if whole or len(s) <= 256:
        return b"w" + s.tobytes()
    steps = np.diff((s >> np.uint64(32)).astype(np.uint32), prepend=np.uint32(0))
    return b"h" + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(b: bytes) -> tuple[np.ndarray, bool]:
    raw = np.frombuffer(b, np.uint8)[1:]
    if b[:1] == b"w":
        return np.frombuffer(raw.tobytes(), np.uint64), True
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32), False


def _common(a: bytes, b: bytes) -> tuple[int, int, int, int]:
    """Sizes of two packed sets, the most shingles that they have in common and the fewest; halves may agree by chance."""
    (x, wx), (y, wy) = _unpack(a), _unpack(b)
    if wx and wy:
        n = len(np.intersect1d(x, y, assume_unique=True))
        return len(x), len(y), n, n
    x, y = ((v >> np.uint64(32)).astype(np.uint32) if w else v for v, w in ((x, wx), (y, wy)))
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    n = int((y[at] == x).sum())
    # Halves that agree by chance are near len(x) * len(y) / 2**32 many; twice that and twelve more have a chance under 1e-9.
    return len(x), len(y), n, n - 12 - (len(x) * len(y) >> 31)


def _packed_sets(docs: DataFrame, reps: DataFrame, sids: DataFrame, whole: bool) -> DataFrame:
    """(sid, set) of the distinct `sids` and perhaps of others, made again from the texts; a few may stand twice."""
    spark = docs.sparkSession
    wanted = sids.join(reps.select("sid", "doc_id"), "sid")
    at = "coalesce(pmod(xxhash64(cast(doc_id as long)), 16777216), 0)"
    bits = wanted.selectExpr(f"cast({at} div 64 as int) as w", f"shiftleft(1L, cast({at} % 64 as int)) as v").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    held = np.zeros(1 << 18, np.int64)
    if bits.num_rows:
        held[np.asarray(bits["w"].combine_chunks())] = np.asarray(bits["v"].combine_chunks())
    shared = spark.sparkContext.broadcast(held)

    def make(batches):
        seen = set()
        for batch in batches:
            place = np.asarray(batch.column(1))
            keep = np.flatnonzero(shared.value[place >> 6] >> (place & 63) & 1)
            sids, arrays = [], []
            for s in _sets(batch.column(0).take(pa.array(keep))):
                sid = _digest(s)
                if sid not in seen and len(s):
                    seen.add(sid)
                    sids.append(sid)
                    arrays.append(_pack(s, whole))
                if len(sids) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(arrays, pa.binary())], ["sid", "set"])
                    sids, arrays = [], []
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(arrays, pa.binary())], ["sid", "set"])

    return docs.select("text", F.expr(at).alias("at")).mapInArrow(make, "sid long, set binary")


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, whole: bool) -> DataFrame:
    """(a, b, sure) of the pairs that link as far as the packed sets can tell."""
    made = _packed_sets(docs, reps, pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), whole)
    both = pairs.join(made.select(F.col("sid").alias("a"), F.col("set").alias("sa")), "a").join(made.select(F.col("sid").alias("b"), F.col("set").alias("sb")), "b")

    def test(batches):
        for batch in batches:
            a, b, sa, sb = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "sa", "sb"))
            ok, sure = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y, most, least = _common(sa[i].as_py(), sb[i].as_py())
                ok[i], sure[i] = 180 * most >= 80 * (x + y), 180 * least >= 80 * (x + y)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok)), b.filter(pa.array(ok)), pa.array(sure[ok])], ["a", "b", "sure"])

    return both.mapInArrow(test, "a long, b long, sure boolean").distinct()


def verify(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of set digests that link, by intersection of their whole shingle sets.

    Sets are made again from the texts, only for documents whose id is in a fixed-size bitmap of the ids wanted
    (2**24 bits, two megabytes: more wanted ids let more texts through, none is lost). Large sets travel as half hashes: where
    these leave a doubt, the pair is tested again on whole hashes.
    """
    wanted = materialize(pairs)
    first = materialize(_verified(docs, reps, wanted, False))
    release(wanted)
    doubt = first.where("not sure").select("a", "b")
    sure = first.where("sure").select("a", "b")
    return sure if doubt.isEmpty() else sure.unionByName(materialize(_verified(docs, reps, doubt, True)).select("a", "b"))


def linked_counts(one: list[np.ndarray], two: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of `two` each set of `one` links with, and the other way round; without `two`, of `one` itself.

    Sets are taken as differences from one set, which are small among near copies: |A ^ B| = |A'| + |B'| - 2 |A' & B'|.
    """
    same = two is None

    def side(sets):
        own = [np.setxor1d(s, one[0], assume_unique=True) for s in sets]
        d = np.array([len(x) for x in own])
        values, owner = np.concatenate(own), np.repeat(np.arange(len(own)), d)
        order = np.argsort(values, kind="stable")
        return np.array([len(s) for s in sets]), d, values[order], owner[order]

    (nx, dx, vx, ox), (ny, dy, vy, oy) = x, y = (side(one),) * 2 if same else (side(one), side(two))
    keys = np.intersect1d(vx, vy)
    at = [(np.searchsorted(v, keys, "left"), np.searchsorted(v, keys, "right")) for v in (vx, vy)]
    (bx, ex), (by, ey) = at
    work = (ex - bx) * (ey - by)
    common = np.zeros((len(nx), len(ny)), np.float32)  # whole numbers below 2**24
    heavy = np.flatnonzero(100 * work > common.size)
    for k in range(0, len(heavy), 1024):
        picked = heavy[k : k + 1024]
        held = []
        for (b, e), owner, n in zip(at, (x[3], y[3]), (len(nx), len(ny)), strict=True):
            m, times = np.zeros((n, len(picked)), np.float32), (e - b)[picked]
            place = np.repeat(b[picked] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
            m[owner[place], np.repeat(np.arange(len(picked)), times)] = 1
            held.append(m)
        common += held[0] @ held[1].T
    light = np.flatnonzero(100 * work <= common.size)
    total = np.cumsum(work[light])
    k = 0
    while k < len(light):
        # A slice of keys whose pairs are a million at most (one key at least).
        end = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + (1 << 20), "right")))
        picked = light[k:end]
        pairs, width = work[picked], (ey - by)[picked]
        within = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        i, j = np.divmod(within, np.repeat(width, pairs))
        flat = ox[np.repeat(bx[picked], pairs) + i] * len(ny) + oy[np.repeat(by[picked], pairs) + j]
        found, times = np.unique(flat, return_counts=True)
        common.ravel()[found] += times
        k = end
    sizes = nx[:, None] + ny[None]
    # Twice the common shingles are the sizes less the difference.
    ok = 90 * (sizes - dx[:, None] - dy[None] + 2 * common.astype(np.int64)) >= 80 * sizes
    if same:
        np.fill_diagonal(ok, False)
    return ok.sum(1), ok.sum(0)


def links_in_classes(docs: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(sid, links): partial counts of each set's links with sets of its own class (node, component).

    A class of two is one link. A larger one is a block of whole sets, or falls in blocks by size band and hash where its sets are
    many; each pair of sets meets in one pair of blocks, which hands on a count for each set and no pairs.
    """
    members = labels.select(F.col("node").alias("sid"), F.col("component").alias("label")).join(sets.select("sid", "n"), "sid")
    sizes = members.groupBy("label").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    members = materialize(members.join(sizes, "label"))
    two = members.where("m = 2").select("sid", F.lit(1).cast("long").alias("links"))
    more = members.where("m > 2")
    band = F.when((F.col("m") > MEMBERS) | (F.col("w") > SHINGLES), size_band("n")).otherwise(F.lit(-1)).cast("int")
    more = more.select("sid", "label", "n", band.alias("band"))
    parts = more.groupBy("label", "band").agg(F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n") / SHINGLES)).alias("parts"))
    more = more.join(parts, ["label", "band"]).select("sid", "label", "band", F.pmod(F.xxhash64("sid"), F.col("parts")).alias("part"))
    made = _packed_sets(docs, sets, more.select("sid"), True)
    place = ["label", "band", "part"]
    block = materialize(more.join(made, "sid").groupBy(*place).agg(F.collect_list(F.struct("sid", "set")).alias("x")))

    def count(batches):
        for batch in batches:
            got = [], []
            for r in range(batch.num_rows):
                held = []
                for c in batch.columns:
                    by_sid = {v["sid"]: _unpack(v["set"])[0] for v in c[r].as_py()}
                    held.append((np.array(list(by_sid), np.int64), list(by_sid.values())))
                for (sid, _), links in zip(held, linked_counts(*[h[1] for h in held]), strict=False):
                    got[0].append(sid[links > 0])
                    got[1].append(links[links > 0].astype(np.int64))
            if got[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(g)) for g in got], ["sid", "links"])

    names = block.select(*place).where("band >= 0")
    pairs = names.select("label", *[F.col(c).alias(f"{c}1") for c in place[1:]]).join(names.select("label", *[F.col(c).alias(f"{c}2") for c in place[1:]]), "label")
    pairs = pairs.where("(band1, part1) < (band2, part2) and abs(band2 - band1) <= 2")
    for i, name in ((1, "x"), (2, "y")):
        pairs = pairs.join(block.select("label", F.col("band").alias(f"band{i}"), F.col("part").alias(f"part{i}"), F.col("x").alias(name)), ["label", f"band{i}", f"part{i}"])
    schema = "sid long, links long"
    return two.union(block.select("x").mapInArrow(count, schema)).union(pairs.select("x", "y").mapInArrow(count, schema))


def class_meetings(meets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of the meetings (sid, lead, c) of sets in different classes: of each two classes the BETWEEN with the most keys
    in common. A set without a label is a class of its own."""
    side = [labels.select(F.col("node").alias(k), F.col("component").alias(f"l{k}")) for k in ("sid", "lead")]
    named = meets.join(side[0], "sid", "left").join(side[1], "lead", "left").select("sid", "lead", "c", F.coalesce("lsid", "sid").alias("x"), F.coalesce("llead", "lead").alias("y")).where("x <> y")
    pairs = named.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.least("sid", "lead").alias("a"), F.greatest("sid", "lead").alias("b")).agg(F.max("c").alias("c"))
    return pairs.withColumn("r", F.row_number().over(Window.partitionBy("x", "y").orderBy(F.desc("c"), "a", "b"))).where(f"r <= {BETWEEN}").select("a", "b")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (node, component) with those that links (a, b) join."""
    return materialize(connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links)))


def _buckets(shared: DataFrame, labels: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members of the buckets that hold several classes (of buckets with equal members, one stays); small buckets whole, as
    blocks x; and the blocks x of large ones (key, band, part, l0, l1), which are written."""
    named = materialize(shared.drop("part", "c").join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("key", "sid", "n", F.coalesce("component", "sid").alias("label")))
    keys = named.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.bit_xor(F.xxhash64("sid")).alias("s0"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("s1"), F.count("*").alias("c")).where("l0 < l1")
    keys = keys.groupBy("s0", "s1", "c").agg(F.min("key").alias("key")).select("key", "c")
    mixed = materialize(named.join(keys, "key"))
    release(named)
    members = F.collect_list(F.struct("sid", "n", "label", "bits")).alias("x")
    bits = sets.select("sid", "bits")
    small = mixed.where(f"c <= {BUCKET}").join(bits, "sid").groupBy("key").agg(members)
    # A large bucket falls in blocks by size band and class; a class of more members than a block holds is salted.
    large = mixed.where(f"c > {BUCKET}")
    # The counts meet their members in SALTS parts of each class, so that one class is not one task.
    of_class = large.groupBy("key", "label").agg(F.count("*").alias("lc")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = F.when(F.col("lc") > BUCKET, F.xxhash64("label", F.pmod(F.xxhash64("sid"), F.ceil(F.col("lc") / BUCKET)))).otherwise(F.pmod(F.xxhash64("label"), F.ceil(F.col("c") / BUCKET)))
    salted_rows = large.withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(SALTS)).cast("int"))
    large = salted_rows.join(of_class, ["key", "label", "salt"]).drop("salt").join(bits, "sid").groupBy("key", size_band("n").cast("int").alias("band"), salted.alias("part"))
    return mixed, small, materialize(large.agg(members, F.min("label").alias("l0"), F.max("label").alias("l1")))


def _meetings(small: DataFrame, big: DataFrame, most: int | None = None) -> DataFrame:
    """Distinct pairs (a, b) of different classes that the trees of all blocks let link; of each class only the `most` best of
    each block or pair of blocks, if given."""
    inside = _candidates(small, "x", most=most).union(_candidates(big.where("l0 < l1"), "x", most=most))
    # Blocks of one large bucket: each pair of blocks once, if their bands are near and they are not one class.
    one, two = (big.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("band", "part", "l0", "l1")]) for i in (1, 2))
    across = one.join(two, "key").where("(band1, part1) < (band2, part2) and abs(band2 - band1) <= 2 and not (l01 = l11 and l02 = l12 and l01 = l02)")
    for i, name in ((1, "x"), (2, "y")):
        across = across.join(big.select("key", F.col("band").alias(f"band{i}"), F.col("part").alias(f"part{i}"), F.col("x").alias(name)), ["key", f"band{i}", f"part{i}"])
    return inside.union(_candidates(across, "x", "y", most=most)).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, links, text_hash) of each row: links are the number of different texts it links with.

    component_id is the smallest doc_id reachable by links, the row's own included. Null texts, texts without words: no
    shingles, linked with nothing. Equal shingle sets are linked. Rows with equal doc_id are rows of their own. No rows
    give none; very long texts are whole sets like others; extra columns are not read. Frequent shingles (counted in each
    partition, and in a sample of sets over all of them) come last in the prefix order; that order changes the work, never the links.
    """
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        return _near_duplicates(docs)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    index = materialize(shingle_index(docs))
    rows = index.where("n >= 0").select("doc_id", "n", "sid", "t")
    sets = materialize(index.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    # Few sampled ones say nothing; eight of them stand for some five hundred sets.
    told = index.where("n < 0").groupBy("sid").agg(F.sum(F.when(F.col("t").isNull(), -F.col("n")).otherwise(0)).alias("c"), F.sum(F.when(F.col("t") == 1, -F.col("n")).otherwise(0)).alias("k"))
    often = told.select("sid", F.greatest("c", F.when(F.col("k") >= 8, SAMPLED * F.col("k")).otherwise(0)).alias("c")).where("c >= 24").orderBy(F.desc("c")).limit(1 << 20).toArrow()
    common, counts = np.asarray(often["sid"].combine_chunks()).view(np.uint64) if often.num_rows else np.zeros(0, np.uint64), np.asarray(often["c"].combine_chunks()) if often.num_rows else np.zeros(0, np.int64)
    order = np.argsort(common)

    # One exchange by key: repeated postings go, and those without a partner: an earlier (smaller) set that has the key in its
    # short prefix, or a later one for such a set. A hot key's parts do not see each other, so all their members stay.
    part = F.expr("mark div 2").alias("part")
    by_size = Window.partitionBy("key", "part").orderBy("n", "sid")
    post = prefix_postings(docs, common[order], counts[order]).select("key", part, F.expr("mark % 2 = 1").alias("short"), "sid", "n")
    post = post.withColumn("again", F.lag("sid").over(by_size)).where("not (again <=> sid)")
    before = F.last(F.when(F.col("short"), F.col("n")), True).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    post = post.withColumns({"before": before, "after": F.lead("n").over(by_size)})
    post = post.where("part > 0 or 80 * n <= 100 * coalesce(before, 0) or (short and 80 * after <= 100 * n)")
    shared = materialize(post.select("key", "sid", "n", "part", F.count("*").over(Window.partitionBy("key", "part")).alias("c")))

    # Members of a bucket first meet its leader, the one that shares the most (of a large bucket up to LEADERS of them), and
    # the leaders of a hot key's parts one of them. That joins groups of copies in linear work; which pairs meet here changes
    # the work, never the links.
    large = shared.where("c > 2")
    large = materialize(large.join(large.groupBy("sid").agg(F.sum("c").alias("w")), "sid"))
    most = F.slice(F.sort_array(F.collect_list(F.struct("w", "sid")), False), F.lit(1), F.greatest(F.lit(1), F.least(F.lit(LEADERS), F.floor(F.max("c") / 16).cast("int"))))
    leads = materialize(large.groupBy("key", "part").agg(most.alias("l")))
    heads = leads.where("part > 0").select("key", F.col("l")[0].alias("l"))
    heads = heads.join(heads.groupBy("key").agg(F.max("l").alias("head")), "key").select(F.col("l.sid").alias("sid"), F.col("head.sid").alias("lead"), F.lit(0).alias("n"))
    near = large.join(leads, ["key", "part"]).select("sid", F.explode("l.sid").alias("lead"), "n").union(heads).where("sid <> lead").groupBy("sid", "lead").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    best = near.where("50 * c >= n").withColumn("r", F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("c"), "lead"))).where(f"r <= {MEETS}")
    best = materialize(best.select("sid", "lead", "c", "r"))
    release(large, leads)
    first = materialize(verify(docs, sets, _bound(best.where("r = 1").select(F.least("sid", "lead").alias("a"), F.greatest("sid", "lead").alias("b")).distinct(), sets)))
    labels = materialize(connected_components(first))
    # The other leaders count only between classes, and two meetings of each two classes do: a group of copies meets its leader once.
    rest = materialize(class_meetings(best.where("r > 1"), labels))
    if not rest.isEmpty():
        more = materialize(verify(docs, sets, _bound(rest, sets)))
        old, labels = labels, _joined(labels, more)
        release(old, more)
    release(best, rest)

    # Classes that no leader joined first meet their closest ones in each block, as long as that joins some (ROUNDS at most); then
    # all that are still of different classes meet. So sets that link with each other but not with a leader are joined in linear
    # work, and their links counted by class below.
    mixed, small, big = _buckets(shared, labels, sets)
    for _ in range(ROUNDS):
        closer = materialize(verify(docs, sets, _meetings(small, big, CLOSEST)))
        if closer.isEmpty():
            release(closer)
            break
        old, labels = labels, _joined(labels, closer)
        release(mixed, big, old, closer)
        mixed, small, big = _buckets(shared, labels, sets)
    release(shared)
    second = materialize(verify(docs, sets, _meetings(small, big)).distinct())
    release(mixed, big)

    # `second` joins whole classes of `first`: its links between them, each pair of classes once.
    label = [labels.select(F.col("node").alias(c), F.col("component").alias(f"l{c}")) for c in ("a", "b")]
    joined = second.join(label[0], "a", "left").join(label[1], "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    found = connected_components(joined)
    # `second` holds the links between classes of leaders, each once; those inside are counted by class.
    between = second.select(F.explode(F.array("a", "b")).alias("sid"), F.lit(1).cast("long").alias("links"))
    degree = between.union(links_in_classes(docs, sets, labels)).groupBy("sid").agg(F.sum("links").alias("links"))
    ids = sets.select("sid", F.col("doc_id").alias("own")).join(labels.select(F.col("node").alias("sid"), F.col("component").alias("label")), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    ids = ids.join(found.withColumnRenamed("node", "label"), "label", "left").withColumn("component", F.coalesce("component", "label"))
    least = ids.groupBy("component").agg(F.min("own").alias("component_id"))
    classes = materialize(ids.join(least, "component").join(degree, "sid", "left").select("sid", "component_id", F.coalesce("links", F.lit(0)).alias("links")))
    release(sets, first, second, labels)
    out = rows.join(classes, "sid", "left")
    alone = F.col("n") == 0
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, 0).otherwise(F.col("links")).cast("long").alias("links"), F.col("t").alias("text_hash"))
