"""Language identification: each document as a mixture of languages, by expectation-maximisation over word likelihoods."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import mix, slices, text_buffers


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode's letter categories."""
    return any(map(str.isalpha, text))


def _grams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character trigrams inside words, in 2**bits hash buckets: bucket of each, where words begin, where texts begin."""
    low = "\0".join(t.lower() for t in texts) + "\0"
    c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Anything up to `@` and the ASCII marks between and after the letters parts words.
    word = (c > 96) & ((c < 123) | (c > 0xBF))
    p = np.where(word, c, 32).astype(np.uint64)
    prev = np.r_[np.uint64(32), p[:-1]]
    prev2 = np.r_[np.uint64(32), prev[:-1]]
    prev2[prev == 32] = 32
    at = np.flatnonzero(word | (prev != 32))  # letters, and the end of each word
    h = mix((p[at] * np.uint64(0x1F123BB5) + prev[at] * np.uint64(0x9E3779B1)) * np.uint64(0x85EBCA77) + prev2[at])
    begins = np.flatnonzero(word[at] & (prev[at] == 32))
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    return (h >> np.uint64(64 - bits)).astype(np.int64), begins, np.searchsorted(at[begins], np.r_[0, ends])


def train(docs: DataFrame, bits: int = 17, rows: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Trigram log-likelihoods of each language, a 2**bits x languages table of float32.

    Learned from at most about `rows` labelled documents of each language (a documented bound of the sample: rows are
    taken by hash, at one rate a language); only text and lang of documents outside the held-out fold are read. Languages
    are ordered by name. Counts are summed in partitions before the shuffle.
    """
    d = docs.select("text", "lang", F.crc32(F.col("doc_id").cast("string")).alias("_f")).where("text is not null and lang is not null and _f % 4 <> 2")
    found = {r[0]: r[1] for r in d.groupBy("lang").count().collect()}
    langs = sorted(found)
    if not langs:
        return [], np.zeros((1 << bits, 0), np.float32)
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    rate = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, rows / found[lang]))])
    d = d.where(F.pmod(F.xxhash64("_f"), F.lit(1 << 20)) < rate[F.col("lang")] * (1 << 20)).select(number[F.col("lang")].alias("lang"), "text")

    def count(batches):
        total = np.zeros((len(langs), 1 << bits), np.int32)
        for batch in batches:
            lang = np.asarray(batch.column(0))
            _, offsets = text_buffers(batch.column(1))
            for lo, hi in slices(offsets, 1 << 20):
                for k in np.unique(lang[lo:hi]):
                    own = [t for t, x in zip(batch.column(1)[lo:hi].to_pylist(), lang[lo:hi], strict=True) if x == k]
                    total[k] += np.bincount(_grams(own, bits)[0], minlength=1 << bits).astype(np.int32)
        for k in range(len(langs)):
            at = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(total[k][at].astype(np.int64))], ["lang", "gram", "n"])

    sums = d.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((1 << bits, len(langs)))
    counts[np.asarray(sums["gram"].combine_chunks()), np.asarray(sums["lang"].combine_chunks())] = np.asarray(sums["n"].combine_chunks())
    share = (counts + 0.5) / (counts.sum(0) + 0.5 * (1 << bits))
    return langs, np.log(share).astype(np.float32)


def _em(like: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document. like: words x languages; doc: of each word; allowed: documents x languages."""
    mixed = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    n = np.diff(np.r_[first, len(doc)])[:, None]
    for _ in range(steps):
        part = like * mixed[doc]
        part /= part.sum(1, keepdims=True) + 1e-30
        mixed = np.add.reduceat(part, first) / n
    return mixed, np.add.reduceat(np.log((like * mixed[doc]).sum(1) + 1e-30), first)


def identify(docs: DataFrame, langs: list[str], table: np.ndarray, bits: int = 17, penalty: float = 3.0, steps: int = 12) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) of every whole text.

    A word's likelihood in a language is the product of its trigrams'. Expectation-maximisation over all languages gives
    first proportions; then the sets of the 1, 2, ... strongest languages are fitted, and the one with the best
    log-likelihood less `penalty` * log(words) for each further language is chosen. lang_pred is its largest part,
    score that part's share times the share of words of which most trigrams were seen in training, languages all parts. Null texts, texts without a letter and all texts where no language was
    learned are `und` with score 0; letters without a word of known shape count as one language, the first.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((langs, table))

    def predict(batches):
        names, logs = held.value
        count = len(names)
        # Trigrams that no language has: their value is the least one everywhere.
        seen = (logs > logs.min(0) + 1e-4).any(1) if count else None
        for batch in batches:
            texts_col = batch.column(batch.schema.get_field_index("text"))
            _, offsets = text_buffers(texts_col)
            pred, score, parts = [], [], []
            for lo, hi in slices(offsets, 1 << 20):
                texts = [t or "" for t in texts_col[lo:hi].to_pylist()]
                best, share = np.full(len(texts), -1), np.zeros(len(texts))
                mixed = np.zeros((len(texts), max(count, 1)))
                ok = np.array([bool(count and has_letter(t)) for t in texts])
                best[ok], share[ok] = 0, 1.0 / max(count, 1)
                gram, begins, docs_at = _grams(texts, bits)
                if count and len(begins):
                    word = np.add.reduceat(logs[gram], begins, axis=0).astype(np.float64)
                    like = np.exp(np.maximum(word - word.max(1, keepdims=True), -30))
                    n = np.diff(docs_at)
                    rows = np.flatnonzero(n > 0)
                    doc, first = np.repeat(np.arange(len(rows)), n[rows]), docs_at[:-1][rows]
                    full, _ = _em(like, doc, first, np.ones((len(rows), count)), steps)
                    order = np.argsort(-full, axis=1, kind="stable")
                    chosen, value = None, None
                    for k in range(1, count + 1):
                        allowed = np.zeros((len(rows), count))
                        np.put_along_axis(allowed, order[:, :k], 1.0, 1)
                        m, fit = _em(like, doc, first, allowed, steps if k > 1 else 1)
                        fit = fit - penalty * (k - 1) * np.log(n[rows] + 1)
                        if chosen is None:
                            chosen, value = m, fit
                        else:
                            better = fit > value
                            chosen[better], value[better] = m[better], fit[better]
                    rows_ok = ok[rows]
                    best[rows[rows_ok]] = chosen.argmax(1)[rows_ok]
                    grams = np.diff(np.r_[begins, len(gram)])
                    familiar = 2 * np.add.reduceat(seen[gram].astype(np.int64), begins) >= grams
                    share[rows[rows_ok]] = (chosen.max(1) * np.add.reduceat(familiar, first, dtype=np.int64) / n[rows])[rows_ok]
                    mixed[rows] = chosen
                pred += [names[b] if b >= 0 else "und" for b in best]
                score += np.clip(np.where(best >= 0, share, 0.0), 0.0, 1.0).tolist()
                parts += [[names[k] for k in np.flatnonzero(m > 0.01)] if b >= 0 else [] for m, b in zip(mixed, best, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("held_out")), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(parts, pa.list_(pa.string()))], ["doc_id", "held_out", "lang_pred", "score", "languages"])

    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    out = docs.select(F.col("doc_id").cast("long"), "text", fold.alias("held_out"))
    return out.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Learn from the training fold of `docs` and identify all of them.

    Repeated rows are predicted alike; no rows give none; equal proportions go to the first language by name. Null texts
    and those without a letter are `und`. Very long texts are scored whole, each in one piece; extra columns are not read.
    """
    langs, logs = train(docs)
    return identify(docs, langs, logs)
