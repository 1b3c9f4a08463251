"""Ranked lexical search: exact inner products of items and documents, found in ball trees over sparse document vectors."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, slices, text_buffers
from ledgerline.llm.decontam import benchmark_parts

#: Term characters are 0-9, A-Z (lower-cased), a-z and everything beyond ASCII; all else parts terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
LEAF, BLOCK = 32, 4096  # documents of a leaf, and of a tree
PART_BYTES = 4 << 20  # of items in one pass: bounds what is broadcast
SAMPLE = 8192  # documents that give the first lower bounds
HITS = "query int, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


def document_vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of each text with a term: its n terms, and the counts of those in the (sorted) vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches):
        known = pa.array(held.value, pa.binary())
        size = max(len(known), 1)
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(text_buffers(column)[1], 1 << 20):
                texts = [terms(t) for t in column[lo:hi].cast(pa.large_binary()).to_pylist()]
                n = np.array([len(t) for t in texts])
                place = pc.index_in(pa.array([w for t in texts for w in t], pa.binary()), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
                key = (np.repeat(np.arange(len(texts)), n) * size + place)[place >= 0]
                key, tf = np.unique(key, return_counts=True)
                at = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * size).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(v.astype(np.int32))) for v in (key % size, tf)]
                rows = pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "counts"])
                yield rows.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(vectors, "doc_id long, n long, terms array<int>, counts array<int>")


class Queries:
    """Items as sparse integer vectors over the vocabulary, by term."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray):
        self.weight, self.count = weight, len(items)
        which = np.repeat(np.arange(self.count), [len(t) for t in items])
        term = np.concatenate([np.zeros(0, np.int64), *items]).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.item = which[order]
        self.at = np.searchsorted(term[order], np.arange(len(weight) + 1))
        total = np.bincount(which, weight[term], self.count)
        # In the space scaled by the root of the weights a query has the length of the root of its sum.
        self.norm = np.sqrt(total)
        # Sums under 2**53 are exact in doubles, in any order.
        self.kind = np.float64 if total.max(initial=0) * 1e6 < 2**52 else np.int64

    def norms(self, used: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
        """Scaled length of each item within each group of the terms used (groups x items)."""
        n = self.at[used + 1] - self.at[used]
        item = self.item[np.repeat(self.at[used] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        return np.sqrt(np.bincount(np.repeat(group, n) * self.count + item, np.repeat(self.weight[used], n), groups * self.count)).reshape(groups, self.count)

    def columns(self, used: np.ndarray) -> np.ndarray:
        """Dense rows of the terms used: the weight where an item has the term."""
        out = np.zeros((len(used), self.count), self.kind)
        n = self.at[used + 1] - self.at[used]
        row = np.repeat(np.arange(len(used)), n)
        out[row, self.item[np.repeat(self.at[used] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(row))]] = self.weight[used][row]
        return out

    def times(self, group: np.ndarray, term: np.ndarray, value: np.ndarray, groups: int) -> np.ndarray:
        """Inner products of sparse vectors (one of each group) with all items."""
        n = self.at[term + 1] - self.at[term]
        entry = np.repeat(np.arange(len(term)), n)
        item = self.item[np.repeat(self.at[term] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(entry))]
        return np.bincount(group[entry] * self.count + item, (value * self.weight[term])[entry], groups * self.count).reshape(groups, self.count)


class BallTree:
    """A balanced tree over at most BLOCK documents: a node splits at the median of the line between two far documents.

    Levels hold for each node its size, radii and the products of its centroid with all items (taken at the leaves; a node's
    is the mean of its children's). Radii live in the space where each term is scaled by the root of its weight. Besides the ball
    in all terms there is one for each of some groups of terms, where the node's documents have most of them: documents
    of one subject are near each other in the terms of all others, so an item of another subject has a low bound there.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, size: int, queries: Queries):
        self.depth = max(0, math.ceil(math.log2(max(size, 1) / LEAF)))
        scaled = value * np.sqrt(queries.weight[term])
        used, local = np.unique(term, return_inverse=True)
        square = np.bincount(doc, scaled * scaled, size)
        order = np.arange(size)  # documents by leaf
        self.cuts, levels = [np.array([0, size])], []
        for level in range(self.depth + 1):
            cuts = self.cuts[level]
            nodes, n = len(cuts) - 1, np.diff(cuts)
            node = np.empty(size, np.int64)
            node[order] = np.repeat(np.arange(nodes), n)
            key, entry = np.unique(node[doc] * len(used) + local, return_inverse=True)
            owner, of = key // max(len(used), 1), key % max(len(used), 1)
            centre = np.bincount(entry, scaled, len(key)) / n[owner]
            levels.append((node, entry, owner, of, centre))
            if level == self.depth:
                products = queries.times(owner, used[of], np.bincount(entry, value, len(key)), nodes)
                break
            apart = square - 2 * np.bincount(doc, scaled * centre[entry], size) + np.bincount(owner, centre * centre, nodes)[node]
            first = self._furthest(apart, order, cuts)
            far = self._inner(first, doc, scaled, entry, len(key), size)
            second = self._furthest(square - 2 * far + square[first][node], order, cuts)
            along = self._inner(second, doc, scaled, entry, len(key), size) - far
            order = order[np.lexsort((order, along[order], node[order]))]
            self.cuts.append(np.unique(np.r_[cuts, (cuts[:-1] + cuts[1:] + 1) // 2]))
        self.order = order
        # Each term's group: the node of the fifth level at most that holds most of it.
        node, entry, owner, of, centre = levels[min(self.depth, 4)]
        groups = int(node.max(initial=0)) + 1
        by_mass = np.lexsort((owner, -centre, of))
        group = owner[by_mass][np.searchsorted(of[by_mass], np.arange(len(used)))] if len(used) else of
        norms = queries.norms(used, group, groups)
        cell = doc * groups + group[local]
        squares = np.bincount(cell, scaled * scaled, size * groups).reshape(size, groups)
        self.bound = [None] * (self.depth + 1)
        for level in range(self.depth, -1, -1):
            node, entry, owner, of, centre = levels[level]
            cuts = self.cuts[level]
            nodes = len(cuts) - 1
            own = np.bincount(owner * groups + group[of], centre * centre, nodes * groups).reshape(nodes, groups)[node]
            apart = squares - 2 * np.bincount(cell, scaled * centre[entry], size * groups).reshape(size, groups) + own
            # The slack covers the rounding of the sums, so that no radius is too small.
            slack = 1e-10 * (squares + own)
            radii = np.sqrt(np.maximum.reduceat((np.maximum(apart, 0) + slack)[self.order], cuts[:-1]))
            radius = np.sqrt(np.maximum.reduceat((np.maximum(apart.sum(1), 0) + slack.sum(1))[self.order], cuts[:-1]))
            reach = np.minimum(queries.norm * radius[:, None], radii @ norms)
            self.bound[level] = (products / np.diff(cuts)[:, None] + reach) * (1 + 1e-9) + 1
            products = products.reshape(-1, 2, queries.count).sum(1) if level else products

    @staticmethod
    def _furthest(apart, order, cuts):
        """The document of each node with the largest distance."""
        n = np.diff(cuts)
        node = np.repeat(np.arange(len(n)), n)
        return order[np.lexsort((apart[order], node))[cuts[1:] - 1]]

    @staticmethod
    def _inner(pivot, doc, scaled, entry, entries, size):
        """Inner product of every document with its node's pivot."""
        chosen = np.zeros(size, bool)
        chosen[pivot] = True
        mine = chosen[doc]
        dense = np.zeros(entries)
        dense[entry[mine]] = scaled[mine]
        return np.bincount(doc, scaled * dense[entry], size)


class Best:
    """The best `top` documents of each item so far, and the score that a document must reach."""

    def __init__(self, count: int, top: int, floor: np.ndarray):
        self.top, self.held = top, np.zeros((count, top))
        self.least = np.maximum(floor, 1).astype(np.float64)
        self.hits: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, items: np.ndarray, ids: np.ndarray, missing: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least[items]
        if not good.any():
            return
        row, col = np.nonzero(good)
        self.hits.append((items[col], missing[row], ids[row], scores[row, col].astype(np.int64)))
        self.size += len(row)
        both = np.concatenate([self.held[items], scores.T], axis=1)
        self.held[items] = np.partition(both, both.shape[1] - self.top, axis=1)[:, -self.top :]
        self.least[items] = np.maximum(self.least[items], self.held[items].min(1))
        if self.size > 1 << 20:
            self.hits = [self.rows()]
            self.size = len(self.hits[0][0])

    def rows(self) -> tuple[np.ndarray, ...]:
        if not self.hits:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, missing, ids, score = (np.concatenate(x) for x in zip(*self.hits, strict=True))
        order = np.lexsort((ids, missing, -score, item))
        item = item[order]
        kept = order[np.arange(len(item)) - np.searchsorted(item, item) < self.top]
        kept = kept[score[kept] >= self.least[np.concatenate([h[0] for h in self.hits])[kept]]]
        return tuple(np.concatenate(x)[kept] for x in zip(*self.hits, strict=True))


def search_tree(tree: BallTree, queries: Queries, best: Best, ids, missing, at, term, value) -> int:
    """Best-first: the subtree whose bound is furthest above what some item still needs comes first. Returns the documents scored."""
    scored = 0
    needed = lambda level, node, items: float((tree.bound[level][node, items] - best.least[items]).max(initial=-1))
    every = np.arange(queries.count)
    heap = [(-needed(0, 0, every), 0, 0, every)] if queries.count and len(ids) else []
    while heap:
        _, level, node, items = heapq.heappop(heap)
        items = items[tree.bound[level][node, items] >= best.least[items]]
        if not len(items):
            continue
        if level < tree.depth:
            for child in (2 * node, 2 * node + 1):
                urgent = needed(level + 1, child, items)
                if urgent >= 0:
                    heapq.heappush(heap, (-urgent, level + 1, child, items))
            continue
        docs = tree.order[tree.cuts[level][node] : tree.cuts[level][node + 1]]
        scored += len(docs)
        n = at[docs + 1] - at[docs]
        entry = np.repeat(at[docs] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        used, local = np.unique(term[entry], return_inverse=True)
        matrix = np.zeros((len(docs), len(used)), queries.kind)
        matrix[np.repeat(np.arange(len(docs)), n), local] = value[entry]
        best.add(items, ids[docs], missing[docs], matrix @ queries.columns(used)[:, items])
    return scored


def _blocks(batch: pa.RecordBatch):
    """Row ranges of at most BLOCK documents and about half a million terms."""
    at = batch.column(2).offsets.to_numpy().astype(np.int64)
    row = 0
    while row < batch.num_rows:
        end = min(row + BLOCK, max(row + 1, int(np.searchsorted(at, at[row] + (1 << 19), "right")) - 1), batch.num_rows)
        yield row, end
        row = end


def search(vectors: DataFrame, items: list[np.ndarray], weight: np.ndarray, documents: int, length: int, floor: np.ndarray, top: int) -> DataFrame:
    """Hits (query, doc_id, score): the best `top` documents of each item in each task; none that scores under `floor`."""
    held = vectors.sparkSession.sparkContext.broadcast((items, weight, floor))

    def run(batches):
        items, weight, floor = held.value
        blocks = [(q, min(q + 256, len(items))) for q in range(0, len(items), 256)]
        groups = [Queries(items[a:b], weight) for a, b in blocks]
        bests = [Best(g.count, top, floor[a:b]) for g, (a, b) in zip(groups, blocks, strict=True)]
        for batch in batches:
            for lo, hi in _blocks(batch):
                part = batch.slice(lo, hi - lo)
                missing = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy(zero_copy_only=False)
                lists = part.column(2)
                at = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
                term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(hi - lo), np.diff(at))
                measure = 50 + (50 * n * documents) // length
                value = (1_000_000_000 * tf) // (1000 * tf + 20 * measure[doc])
                for g, best in zip(groups, bests, strict=True):
                    tree = BallTree(doc, term, value.astype(np.float64), hi - lo, g)
                    search_tree(tree, g, best, ids, missing, at, term, value)
        for (first, _), best in zip(blocks, bests, strict=True):
            item, missing, ids, score = best.rows()
            yield pa.RecordBatch.from_arrays([pa.array((item + first).astype(np.int32)), pa.array(ids.astype(np.int64), mask=missing.astype(bool)), pa.array(score.astype(np.int64))], ["query", "doc_id", "score"])

    return vectors.mapInArrow(run, HITS)


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    """The best `top` of each query: first in parts of each query, so that no task meets all hits of one."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    first = hits.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)


def rank_documents(docs: DataFrame, benchmark: DataFrame, top: int = 50, sample: int = SAMPLE, most: int = PART_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item by the integer score of the contract, exactly.

    A document is a sparse vector of integers, (10^9 tf) div (1000 tf + 20 m), over the terms of the items; an item has the
    weight of each of its terms once. Texts are cut into terms once, into a table of vectors. Each task builds balanced ball
    trees over blocks of its documents and searches them best-first for all items together: a subtree goes when for each item
    centroid product + radius * norm, rounded up, stays below the score of its `top`-th document so far; leaves are scored
    in exact integer arithmetic. The first such scores come from about `sample` documents chosen by hash (lower bounds,
    which decide no result). Tasks return `top` rows an item at most; their ranks are taken in two steps.

    Equal scores go by ascending doc_id, null last. Texts without terms, null ones too, count nowhere; items without terms
    have no rows; repeated items count once, repeated rows of documents each. Very long texts are read whole, with some
    100 bytes of arrays a term; empty tables give no rows; extra columns are not read. Items are taken in parts of at most
    `most` bytes, each one pass over the documents: what is broadcast (an item's terms, their weights, scores to reach) is
    bounded by the part.
    """
    out = None
    for part in benchmark_parts(benchmark, most):
        rows = part.orderBy("item_id", "text").toArrow()
        words = [sorted(set(terms(t.encode()))) for t in rows["text"].to_pylist()]
        vocabulary = sorted({w for ws in words for w in ws})
        place = {w: k for k, w in enumerate(vocabulary)}
        items = [np.array([place[w] for w in ws], np.int64) for ws in words]
        vectors = materialize(document_vectors(docs, vocabulary))
        documents, length = (int(v or 0) for v in vectors.agg(F.count("*"), F.sum("n")).first())
        held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[held["term"].to_numpy()] = held["count"].to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.float64)
        floor = np.zeros(len(items), np.int64)
        every = documents // max(sample, 1)
        if every > 1:
            few = vectors.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(every)) == 0)
            least = _ranked(search(few, items, weight, documents, length, floor, top), top).where(F.col("rank") == top).toArrow()
            floor[least["query"].to_numpy()] = least["score"].to_numpy()
        names = docs.sparkSession.createDataFrame(list(enumerate(rows["item_id"].to_pylist())), "query int, item_id long")
        got = _ranked(search(vectors, items, weight, documents, length, floor, top), top).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = got if out is None else out.union(got)
    return out


RANKS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), s AS (SELECT count(*) AS docs, sum(len(ts)) AS terms FROM d WHERE len(ts) > 0
), q AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) x WHERE t IN (SELECT t FROM q) GROUP BY r, t
), w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, s GROUP BY t, docs
), m AS (SELECT r, doc_id, 50 + (50 * len(ts) * docs) // terms AS m FROM d, s WHERE len(ts) > 0
), c AS (SELECT item_id, text, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY item_id, text, r, doc_id
), o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50
"""
