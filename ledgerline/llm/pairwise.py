"""Quality classifier: Bradley-Terry scores learned from preference pairs, cut at a quantile of the scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, text_buffers, word_hashes

CUT = 0.7  # the score of a document at the quantile
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".,;:?", "!", "\"'()-", "#*$%&|<>@^~=+_\\/[]{}`"]
_KIND = np.full(256, len(_CLASSES) + 1, np.int64)  # control characters
_KIND[128:192], _KIND[192:] = len(_CLASSES) + 2, len(_CLASSES)
for _k, _chars in enumerate(_CLASSES):
    _KIND[list(_chars.encode())] = _k
KINDS = len(_CLASSES) + 3
SHAPES = ("empty", "words", "bytes_a_word", "distinct", "same_as_before", "repeated_triples", "lines", "repeated_lines", "initial_capitals", "all_capitals", "short_words")
WIDTH = KINDS * KINDS + len(SHAPES)


def _distinct(row: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """How many different keys each row has."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])][: len(row)]
    return np.bincount(row[new], minlength=rows)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text: shares of neighbouring pairs of character kinds, and shapes of its words and lines."""
    rows, size = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((rows, WIDTH))
    kind, row = _KIND[data], np.repeat(np.arange(rows), size)
    inside = row[1:] == row[:-1]
    pair = (row[1:] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:])[inside]
    out[:, : KINDS * KINDS] = np.bincount(pair, minlength=rows * KINDS * KINDS).reshape(rows, -1) / np.maximum(size - 1, 1)[:, None]
    words, at = word_hashes(data, offsets)
    n = np.diff(at)
    some, of = np.maximum(n, 1), np.repeat(np.arange(rows), n)
    before = (of[1:] == of[:-1]) if len(of) else np.zeros(0, bool)
    same = np.bincount(of[1:][before & (words[1:] == words[:-1])], minlength=rows)
    triple = (of[2:] == of[:-2]) if len(of) > 2 else np.zeros(0, bool)
    runs = (words[:-2] * np.uint64(3) + words[1:-1]) * np.uint64(0x9E3779B97F4A7C15) + words[2:] if len(of) > 2 else words[:0]
    triples = np.bincount(of[: len(triple)][triple], minlength=rows)
    space = (kind == 3) | (kind == 4)
    first = ~space & np.r_[True, space[:-1] | ~inside][: len(data)] if len(data) else space
    last = ~space & np.r_[space[1:] | ~inside, True][: len(data)] if len(data) else space
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    upper = np.r_[0, np.cumsum(kind == 1)]
    lower = np.r_[0, np.cumsum(kind == 0)]
    capitals = (upper[end] - upper[begin] > 1) & (lower[end] == lower[begin])
    line = np.cumsum(kind == 4) - (kind == 4)  # of each byte; each word is in one
    number = line[begin]
    new = np.r_[True, (number[1:] != number[:-1]) | (of[1:] != of[:-1])][: len(of)]
    head = np.flatnonzero(new)
    place = np.arange(len(of)) - np.repeat(head, np.diff(np.r_[head, len(of)]))
    with np.errstate(over="ignore"):
        lines = np.add.reduceat(words * (2 * place.astype(np.uint64) + np.uint64(1)), head) if len(head) else words[:0]
    held = np.bincount(of[head], minlength=rows)
    shapes = (
        n == 0,
        np.log1p(n) / 10,
        np.log1p(np.bincount(of, end - begin, rows) / some),
        _distinct(of, words, rows) / some,
        same / some,
        1 - _distinct(of[: len(triple)][triple], runs[triple], rows) / np.maximum(triples, 1),
        held / some,
        1 - _distinct(of[head], lines, rows) / np.maximum(held, 1),
        np.bincount(of, kind[begin] == 1, rows) / some,
        np.bincount(of, capitals, rows) / some,
        np.bincount(of, end - begin < 3, rows) / some,
    )
    out[:, KINDS * KINDS :] = np.array(shapes, float).T
    return out


def _feature_rows(column: pa.Array):
    data, offsets = text_buffers(column)
    for lo, hi in slices(offsets):
        yield features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def sample_labels(labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, quality) of the training fold: distinct labels 0 and 1, about `rows` of each at most, chosen by a hash of doc_id."""
    own = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("quality IN (0, 1) AND crc32(cast(doc_id AS string)) % 4 <> 2").distinct()
    counts = {r["quality"]: r["count"] for r in own.groupBy("quality").count().collect()}
    share = F.lit(0)
    for quality, n in counts.items():
        share = F.when(F.col("quality") == quality, F.lit(math.ceil(2**20 * min(1.0, rows / n)))).otherwise(share)
    return own.where(F.pmod(F.xxhash64("doc_id", F.lit("pairs")), F.lit(1 << 20)) < share)


def preference_pairs(good: int, bad: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs (better, worse): in each round every row of the larger side meets one of the other, in shifted order."""
    n, rng = max(good, bad), np.random.default_rng(11)
    turns = [(rng.permutation(good)[np.arange(n) % good], rng.permutation(bad)[np.arange(n) % bad]) for _ in range(rounds)]
    return np.concatenate([t[0] for t in turns]), np.concatenate([t[1] for t in turns])


def fit_bradley_terry(good: np.ndarray, bad: np.ndarray, rounds: int = 8, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights w that minimise the mean of log(1 + exp(-w.(better - worse))) over the pairs, with a ridge, by Newton steps."""
    a, b = preference_pairs(len(good), len(bad), rounds)
    w = np.zeros(good.shape[1])
    for _ in range(steps):
        slope, bend = ridge * w, ridge * np.eye(len(w))
        for lo in range(0, len(a), 4096):
            x = good[a[lo : lo + 4096]] - bad[b[lo : lo + 4096]]
            miss = 1 / (1 + np.exp(np.clip(x @ w, -50, 50)))
            slope -= miss @ x / len(a)
            bend += (x * (miss * (1 - miss))[:, None]).T @ x / len(a)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def quantile_cut(good: np.ndarray, bad: np.ndarray, tolerance: float = 0.02) -> float:
    """The quantile of the scores that parts the labels: of all whose mean share of right ones is within the tolerance of the
    best, the one in the widest gap, so that a lone odd document does not draw it to itself."""
    scores = np.sort(np.r_[good, bad])
    gaps, cuts = np.diff(scores), (scores[1:] + scores[:-1]) / 2
    right = 1 - np.searchsorted(np.sort(good), cuts) / len(good) + np.searchsorted(np.sort(bad), cuts) / len(bad)
    near = np.flatnonzero(right >= right.max() - 2 * tolerance)
    level = (near[gaps[near].argmax()] + 0.5) / len(gaps)
    return float(np.quantile(scores, level))


def train(docs: DataFrame, labels: DataFrame, rows: int = 4000) -> tuple[np.ndarray, float] | None:
    """Weights on the features and the constant of the score; None without labels of both kinds in the training fold."""
    chosen = sample_labels(labels, rows)

    def read(batches):
        for batch in batches:
            x = np.concatenate([np.zeros((0, WIDTH)), *_feature_rows(batch.column(1))]).astype(np.float32)
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], ["quality", "x"])

    # The sample has about 2 * rows short rows, so its side of the join is broadcast and texts are read where they lie.
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("quality", "text")
    got = own.mapInArrow(read, "quality int, x array<float>").toArrow().combine_chunks()
    quality = got["quality"].to_numpy()
    if not (quality == 1).any() or not (quality == 0).any():
        return None
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(quality), WIDTH).astype(float)
    order = np.lexsort((*x.T[::-1], quality))  # the same rows in the same order, wherever tasks ran
    x, quality = x[order], quality[order]
    spread = np.maximum(x.std(0), 1e-4)
    good, bad = x[quality == 1] / spread, x[quality == 0] / spread
    w = fit_bradley_terry(good, bad)
    return w / spread, math.log(CUT / (1 - CUT)) - quantile_cut(good @ w, bad @ w)


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        for batch in batches:
            x = np.concatenate([np.zeros((0, WIDTH)), *_feature_rows(batch.column(1))])
            value = 1 / (1 + np.exp(-np.clip(x @ model[0] + model[1], -700, 700))) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(value), pa.array((value >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), fold).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame, rows: int = 4000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text, from preference pairs of labelled training texts.

    A document's strength is linear in its features (kinds of neighbouring characters, shapes of words and lines). Pairs of a
    document of quality 1 and one of quality 0 fit it by logistic loss on feature differences; the fit takes about `rows`
    documents of each label at most, chosen by a hash of doc_id, and 8 pairs for each of the more frequent label. The quantile of
    the sample's strengths that parts the labels (`quantile_cut`) has score 0.7; a document's score is the logistic function of its
    distance from it, predicted is 1 from there on.

    Null and empty texts have features of their own (no words) and are scored like all others; repeated rows are scored alike; a label
    given twice counts once, contradictory ones both; labels that are null or neither 0 nor 1, or without a document, teach
    nothing. Without labels of both kinds every score is 0.5 and predicted 0. Very long texts are read whole (some 100
    bytes of arrays for each byte); an empty table gives no rows; extra columns are not read.
    """
    return score(docs, train(docs, labels, rows))
