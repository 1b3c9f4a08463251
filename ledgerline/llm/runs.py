"""Periodic run detection: seeds on the diagonals of a text's words, extended once for each stretch."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE, slices, text_buffers

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in word numbers `ids`; `ends` holds for each word where its document ends.

    A run of period q and exponent 3 or more overlaps its own shift by q in 2q words at least: so it holds a k-gram of any
    k < 2q twice. The index of k-grams, k = 1, 2, 4, ..., looks after the periods in (k/2, k]: inside a run each k-gram with
    k >= q comes again exactly q words later (nearer would mean a smaller period), and neighbouring occurrences in one document are all the pairs that are needed. A
    k-gram is named exactly, by the names of its halves; places whose k-gram does not come again leave all longer indexes.
    Seeds go by lag and place: the lag's table of what is covered furthest tells which of them begin a new stretch, and
    only these are extended, word by word in both directions.
    """
    n = len(ids)
    name, place = np.unique(ends * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)[1].astype(np.int64), np.arange(n)
    found = [np.zeros((3, 0), np.int64)]
    k = 1
    while len(place):
        order = np.argsort(name[place], kind="stable")
        at, named = place[order], name[place][order]
        again = named[1:] == named[:-1]
        lag = at[1:] - at[:-1]
        near = again & (2 * lag > k) & (lag <= k)
        if near.any():
            seed, lag = at[:-1][near], lag[near]
            order = np.lexsort((seed, lag))
            seed, lag = seed[order], lag[order]
            fresh = np.r_[True, (lag[1:] != lag[:-1]) | (seed[1:] > seed[:-1] + k)]
            first = np.flatnonzero(fresh)
            start, lag = seed[first], lag[first]
            cover = seed[np.r_[first[1:], len(seed)] - 1] + k  # the last seed of each stretch covers furthest
            found.append(_extend(ids, ends, start, cover, lag))
        # Places whose k-gram comes twice: what the index of 2k-grams is made of.
        twice = np.zeros(len(at), bool)
        twice[1:] |= again
        twice[:-1] |= again
        kept = np.sort(at[twice])
        known = np.full(n + 1, -1, np.int64)
        known[kept] = name[kept]
        place = kept[kept + 2 * k <= ends[kept]]
        place = place[known[place + k] >= 0]
        name = np.full(n, -1, np.int64)
        if len(place):
            name[place] = np.unique(known[place] * (known.max() + 1) + known[place + k], return_inverse=True)[1]
        k *= 2
    start, cover, lag = np.concatenate(found, axis=1)
    end = cover + lag
    runs = end - start >= np.maximum(least, exponent * lag)
    order = np.lexsort((lag[runs], start[runs]))
    return start[runs][order], end[runs][order], lag[runs][order]


def _extend(ids: np.ndarray, ends: np.ndarray, start: np.ndarray, cover: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Stretches of words equal to those `lag` later, from `start` up to before `cover`, as far as they go in one document."""
    start, cover = start.copy(), cover.copy()
    live = np.arange(len(start))
    while len(live):
        to = cover[live] + lag[live]
        live = live[to < ends[start[live]]]
        live = live[ids[cover[live]] == ids[cover[live] + lag[live]]]
        cover[live] += 1
    live = np.arange(len(start))
    while len(live):
        live = live[start[live] > 0]
        back = start[live] - 1
        live = live[(ends[back] == ends[start[live]]) & (ids[back] == ids[back + lag[live]])]
        start[live] -= 1
    return np.array([start, cover, lag])


def _collapse(words: list[bytes], dropped: np.ndarray) -> bytes:
    return b" ".join(compress(words, (~dropped).tolist()) if dropped.any() else words)


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """Runs of the words of every whole text: (doc_id, n_words, runs, collapsed).

    A run is a stretch of words with smallest period q (words q apart are identical) that no neighbour extends, of
    max(least, exponent * q) words or more; exponent is 3 or more. runs holds them by start, then period, with word numbers from 0;
    collapsed is the text without the words that any run repeats, joined by one space.

    One pass without a shuffle: a document is a task's own, and its work grows by n log n, whatever it repeats. Null and empty
    texts have no words and no runs; repeated rows are answered alike; a very long text needs some 60 bytes of arrays for each
    of its words; an empty table gives no rows; extra columns are not read.
    """

    def detect(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            _, offsets = text_buffers(column)
            counts, each, joined = [], [], []
            for lo, hi in slices(offsets, 1 << 20):
                texts = [(t or b"").split() for t in column[lo:hi].cast(pa.large_binary()).to_pylist()]
                n = np.array([len(t) for t in texts])
                at = np.r_[0, np.cumsum(n)]
                ids = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                start, end, period = find_runs(ids, np.repeat(at[1:], n), least, exponent)
                drop = np.zeros(at[-1] + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, end, -1)
                dropped = np.cumsum(drop)[:-1] > 0
                joined += [_collapse(t, dropped[at[r] : at[r + 1]]) for r, t in enumerate(texts)]
                row = np.searchsorted(at, start, "right") - 1
                counts.append((n, np.bincount(row, minlength=len(texts))))
                each.append(np.array([start - at[row], end - start, period]))
            n, runs = np.concatenate(counts, axis=1) if counts else np.zeros((2, 0), np.int64)
            start, length, period = (pa.array(x) for x in (np.concatenate(each, axis=1) if each else np.zeros((3, 0), np.int64)))
            items = pa.StructArray.from_arrays([start, length, period], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(runs)].astype(np.int32)), items)
            text = pa.array(joined, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(n.astype(np.int64)), lists, text], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(detect, RUNS)


def with_planted_periods() -> Column:
    """The text of the contract's query: one document in ten, by the crc32 of its doc_id, repeats some of its words from some word on."""
    words = F.array_remove(F.split("text", SPACE + "+", -1), "")
    n, h = F.size(words), F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    altered = F.concat_ws(" ", F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), altered).otherwise(F.col("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The contract's row for each document, derived from the runs: the run of greatest exponent, and two digests."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    greater = lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), greater)
    return (
        periodic_runs(docs.withColumn("text", with_planted_periods()))
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            "best.start",
            "best.length",
            "best.period",
            F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
            F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
