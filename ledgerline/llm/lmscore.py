"""LM scoring by cross-entropy difference: target and background bigram models over one shared vocabulary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, is_small, materialize, mix, slices, text_buffers, word_hashes

WEIGHT = 4.0  # of the word's estimate in the pair's
SHARE = 2.0**-21  # of all words: what is rarer is left out of bounded models, so each has 2**21 entries at most
BLOCK = 1 << 23  # most bytes of the texts that are scored together (one text at least)
SPAN = 1 << 21  # bytes of text for which there is one range of keys
LOSSES = ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"]
LOSS_SCHEMA = "doc_id long, n_tokens long, target_loss double, background_loss double, difference double"
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _words(column: pa.Array):
    """(row range, word hashes, word offsets) of slices of a text column."""
    data, offsets = text_buffers(column)
    for lo, hi in slices(offsets):
        words, at = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, words, at


def _id_pairs(words: np.ndarray, at: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each word (its place in the sorted vocabulary from 1; 0 for all others), the pair with the number before, and
    which words begin a text and so have no pair."""
    distinct, back = np.unique(words, return_inverse=True)
    place = np.minimum(np.searchsorted(vocabulary, distinct), max(len(vocabulary) - 1, 0))
    known = vocabulary[place] == distinct if len(vocabulary) else np.zeros(len(distinct), bool)
    number = np.where(known, place + 1, 0)[back].astype(np.int64)
    first = np.zeros(len(words), bool)
    first[at[:-1][at[:-1] < at[1:]]] = True
    return number, np.r_[0, number[:-1]][: len(number)] << 32 | number, first


class _Counts:
    """Counts of keys in the background and the target, combined as they come."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, flags: np.ndarray) -> None:
        keys, back, n = np.unique(keys, return_inverse=True, return_counts=True)
        target = np.bincount(back, flags, len(keys)).astype(np.int64)
        self._put(keys, n - target, target)

    def _put(self, *part: np.ndarray) -> None:
        self.held.append(part)
        self.size += len(part[0])
        if self.size > 1 << 21:
            self.merge()

    def merge(self) -> None:
        if len(self.held) > 1:
            keys, back = np.unique(np.concatenate([h[0] for h in self.held]), return_inverse=True)
            sums = [np.bincount(back, np.concatenate([h[k] for h in self.held]), len(keys)).astype(np.int64) for k in (1, 2)]
            self.held, self.size = [(keys, *sums)], len(keys)

    def batches(self, least: int = 0):
        """The counts so far, if they are more than `least` keys; then it is empty again."""
        self.merge()
        if self.size > least:
            keys, *sums = self.held[0]
            self.held, self.size = [], 0
            for k in range(0, len(keys), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 17)].view(np.int64)) for x in (keys, *sums)], ["key", "c0", "c1"])


def _counted(docs: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """(key, c0, c1): how often each word (pairs of numbers if there is a vocabulary) stands in the background and the target.
    Partitions are combined before the shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        known, total = held.value, _Counts()
        for batch in batches:
            flag = np.asarray(batch.column(1).fill_null(0)).astype(np.int64)
            for lo, hi, words, at in _words(batch.column(0)):
                own = np.repeat(flag[lo:hi], np.diff(at))
                if known is None:
                    total.add(words, own)
                else:
                    _, pair, first = _id_pairs(words, at, known)
                    total.add(pair[~first], own[~first])
            if total.size > 1 << 21:  # more distinct keys than a task should hold
                yield from total.batches(1 << 21)
        yield from total.batches()

    got = docs.select("text", "target").mapInArrow(count, "key long, c0 long, c1 long")
    return got.groupBy("key").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def _kept(counts: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the counts that are `least` or more, sorted as unsigned, and their counts (rows: background, target)."""
    got = counts.where(F.col("c0") + F.col("c1") >= least).toArrow()
    if not got.num_rows:
        return np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
    key, c0, c1 = (np.asarray(got[c].combine_chunks()) for c in ("key", "c0", "c1"))
    order = np.argsort(key.view(np.uint64))
    return key.view(np.uint64)[order], np.stack([c0, c1])[:, order]


def train(docs: DataFrame, share: float = SHARE) -> tuple:
    """Both models from rows (text, target): (vocabulary, counts of <rest> and its words, pairs, counts of the pairs).

    All words and then all pairs of the corpus are counted exactly by shuffle, in tables that grow with it. The models keep
    words and pairs that are `share` of all words or more, 1 / share entries at most whatever the corpus, and only these
    are broadcast. Rarer words are one class, <rest>, number 0; rarer pairs fall back on their word.
    """
    words = materialize(_counted(docs, None))
    total = words.agg(F.sum("c0"), F.sum("c1")).first()
    whole = np.array([total[0] or 0, total[1] or 0], np.int64)
    least = share * whole.sum()
    vocabulary, counts = _kept(words, least)
    counts = np.concatenate([(whole - counts.sum(1))[:, None], counts], 1)
    pairs, pair_counts = _kept(_counted(docs, vocabulary), least)
    return vocabulary, counts, pairs.view(np.int64), pair_counts


def _own(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each token, how often its key stands in its own row."""
    mixed = mix(mix(key.astype(np.uint64)) + row.astype(np.uint64) * _SALT)
    _, back, n = np.unique(mixed, return_inverse=True, return_counts=True)
    return n[back]


def _losses(ids, n: np.ndarray, row: np.ndarray, first: np.ndarray, flags: np.ndarray, counts: tuple, own: tuple, total: np.ndarray, size: int) -> pa.RecordBatch:
    """The losses of some rows, from the counts (words, pairs; background and target) and own counts of each of their tokens."""
    (words, pairs), (own_word, own_pair), sums = counts, own, []
    for m in (0, 1):
        less = flags[row] == m
        word = np.maximum(words[m] - less * own_word, 0)
        both = np.maximum(pairs[m] - less * own_pair, 0)
        one = (word + 1.0) / (total[m] - less * n[row] + size)
        two = (both + WEIGHT * one) / (np.maximum(np.r_[0, word[:-1]][: len(word)], both) + WEIGHT)
        sums.append(np.bincount(row, -np.log(np.where(first, one, two)), len(n)))
    mean = [pa.array(s / np.maximum(n, 1), mask=n == 0) for s in (sums[1], sums[0], sums[1] - sums[0])]
    return pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), *mean], LOSSES)


def score(docs: DataFrame, models: tuple) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference): mean loss of a token in nats; lower difference is nearer
    the target. Both models are interpolated alike: a pair's estimate falls back on the word's, that one on the uniform.
    A document's own counts are taken off the model that learned from it (`target` says which), so none profits from itself."""
    held = docs.sparkSession.sparkContext.broadcast(models)

    def losses(batches):
        vocabulary, counts, pairs, pair_counts = held.value
        total, size = counts.sum(1), counts.shape[1]
        for batch in batches:
            flags = np.asarray(batch.column(2).fill_null(0)).astype(np.int64)
            for lo, hi, words, at in _words(batch.column(1)):
                n = np.diff(at)
                row = np.repeat(np.arange(hi - lo), n)
                number, pair, first = _id_pairs(words, at, vocabulary)
                own_word = _own(row, number)
                own_pair = np.zeros(len(number), np.int64)
                own_pair[~first] = _own(row[~first], pair[~first])
                distinct, back = np.unique(pair, return_inverse=True)
                place = np.minimum(np.searchsorted(pairs, distinct), max(len(pairs) - 1, 0))
                known = pairs[place] == distinct if len(pairs) else np.zeros(len(distinct), bool)
                found = np.where(known, pair_counts[:, place], 0)[:, back] if len(pairs) else np.zeros((2, len(number)), np.int64)
                yield _losses(batch.column(0)[lo:hi], n, row, first, flags[lo:hi], (counts[:, number], found), (own_word, own_pair), total, size)

    return docs.select("doc_id", "text", "target").mapInArrow(losses, LOSS_SCHEMA)


def _in_blocks(docs: DataFrame) -> DataFrame:
    """(block, rows, size): neighbouring rows (doc_id, text, target) of BLOCK bytes at most in one compressed value, and their
    bytes of text. Written, so that it stays."""

    def pack(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            offsets = text_buffers(batch.column(1))[1]
            for lo, hi in slices(offsets, BLOCK):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(batch.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()]), pa.array([offsets[hi] - offsets[lo]])], ["block", "rows", "size"])
                block += 1

    return materialize(docs.select("doc_id", "text", F.coalesce("target", F.lit(0)).alias("target")).mapInArrow(pack, "block long, rows binary, size long"))


def _unpacked(rows: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def _keys(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words (even) and of the pairs with the word before (odd), and which words begin a text and so have no pair."""
    first = np.zeros(len(words), bool)
    first[at[:-1][at[:-1] < at[1:]]] = True
    pairs = mix(np.r_[np.uint64(0), words[:-1]][: len(words)] * _SALT + words)
    return words & ~np.uint64(1), pairs | np.uint64(1), first


def _add(total: _Counts, text, flag: np.ndarray, keep: list | None = None) -> None:
    for lo, hi, words, at in _words(text):
        word, pair, first = _keys(words, at)
        own = np.repeat(flag[lo:hi], np.diff(at))
        total.add(np.r_[word, pair[~first]], np.r_[own, own[~first]])
        if keep is not None:
            keep.append((lo, hi, np.diff(at), word, pair, first))


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as one compressed value, by byte planes: what most of them do not need takes no room."""
    return pa.compress(b"".join(np.ascontiguousarray(c.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns), "zstd", asbytes=True)


def _columns(packed: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, 8 * n * columns, "zstd"), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(c.T).view(np.int64).ravel() for c in raw]


def block_totals(blocks: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """(block, range, n, totals): how often each word and pair of a block stands in the background and the target of the whole
    corpus; and the corpus' words on both sides, and its distinct words.

    The keys fall in ranges, one for each SPAN bytes of text. A block sends a range its own sorted keys, as steps, with their
    counts; the range adds up all blocks and answers each with the totals in the same order, so no key goes back. Nothing is
    left out, and a range holds at most as many keys as it has bytes, whatever the corpus."""
    ranges = max(1, -(-(blocks.agg(F.sum("size")).first()[0] or 0) // SPAN))

    def count(batches):
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs, total = _unpacked(rows), _Counts()
                _add(total, docs["text"], np.asarray(docs["target"]).astype(np.int64))
                total.merge()
                if not total.size:
                    continue
                keys, *counts = total.held[0]
                edges = np.searchsorted((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))
                held = [(k, int(e - b), _planes(np.diff(keys[b:e], prepend=np.uint64(0)), *[c[b:e] for c in counts])) for k, (b, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b < e]
                number, n, packed = zip(*held, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(n), pa.int64()), pa.array(number, pa.int64()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["block", "range", "n", "counts"])

    def add(posts: pa.Table) -> pa.Table:
        n = posts["n"].to_pylist()
        steps, *counts = (np.concatenate(c) for c in zip(*[_columns(v, m, 3) for v, m in zip(posts["counts"].to_pylist(), n, strict=True)], strict=True))
        edges = np.r_[0, np.cumsum(n)]
        keys = np.concatenate([np.cumsum(steps[b:e].view(np.uint64), dtype=np.uint64) for b, e in zip(edges[:-1], edges[1:], strict=True)])
        distinct, back = np.unique(keys, return_inverse=True)
        sums = [np.bincount(back, c, len(distinct)).astype(np.int64) for c in counts]
        word = distinct & np.uint64(1) == 0
        totals = [_planes(*[t[back[b:e]] for t in sums]) for b, e in zip(edges[:-1], edges[1:], strict=True)]
        told = [np.r_[v, np.zeros(len(n) - 1, np.int64)] for v in (sums[0][word].sum(), sums[1][word].sum(), word.sum())]
        return pa.table([posts["block"], posts["range"], posts["n"], pa.array(totals, pa.binary()), *map(pa.array, told)], ["block", "range", "n", "totals", "c0", "c1", "size"])

    posts = blocks.select("block", "rows").mapInArrow(count, "block long, range long, n long, counts binary")
    answers = materialize(posts.groupBy("range").applyInArrow(add, "block long, range long, n long, totals binary, c0 long, c1 long, size long"))
    c0, c1, size = (v or 0 for v in answers.agg(F.sum("c0"), F.sum("c1"), F.sum("size")).first())
    return answers.select("block", "range", "n", "totals"), np.array([c0, c1], np.int64), size


def score_in_blocks(blocks: DataFrame, totals: DataFrame, total: np.ndarray, size: int) -> DataFrame:
    """As `score`, by models of all words and pairs: each block meets the totals of what it holds."""

    def losses(packed: pa.Table, counts: pa.Table) -> pa.Table:
        docs = _unpacked(packed["rows"][0])
        flags, parts, own, out = np.asarray(docs["target"]).astype(np.int64), [], _Counts(), []
        _add(own, docs["text"], flags, parts)
        own.merge()
        keys = own.held[0][0] if own.held else np.zeros(0, np.uint64)
        told = counts.sort_by("range")
        told = [_columns(v, n, 2) for v, n in zip(told["totals"].to_pylist(), told["n"].to_pylist(), strict=True)]
        found = np.stack([np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*told, strict=True) if told else ((), ()))])
        ids = docs["doc_id"].combine_chunks()
        for lo, hi, n, word, pair, first in parts:
            row, own_pair = np.repeat(np.arange(hi - lo), n), np.zeros(len(word), np.int64)
            own_pair[~first] = _own(row[~first], pair[~first])
            held = []
            for key in (word, pair):
                distinct, back = np.unique(key, return_inverse=True)
                at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
                held.append(found[:, at][:, back] if len(keys) else np.zeros((2, len(key)), np.int64))
            held[1][:, first] = 0
            out.append(_losses(ids[lo:hi], n, row, first, flags[lo:hi], tuple(held), (_own(row, word), own_pair), total, size + 1))
        return pa.Table.from_batches(out)

    return blocks.select("block", "rows").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(losses, LOSS_SCHEMA)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """Scores of every whole text: the target model is learned from documents labelled quality 1 and not toxic, the
    background model from all others. Both have the same vocabulary, order and smoothing, and leave out the document scored.

    The models hold all words and pairs of the corpus; with a `share` they are bounded (see `train`). Null texts and texts
    without words have no loss (null). A document with several labels is in the target if one of them fits; repeated rows are
    counted and scored each. Without target labels the target model is uniform. No rows give none; very long texts are
    counted like others, in slices of rows; extra columns are not read.
    """
    good = labels.where("quality = 1 and toxic = 0").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(1))
    good = materialize(good)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(broadcast_if_small(good), "doc_id", "left")
    if share is None:
        blocks = _in_blocks(d)
        return score_in_blocks(blocks, *block_totals(blocks))
    if not is_small(good):
        d = materialize(d)  # the texts move once, not for each of the three passes
    return score(d, train(d, share))
