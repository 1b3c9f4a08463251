"""Periodic runs against a direct reading of their definition."""

import hashlib
import random
import re
import zlib

import numpy as np

from ledgerline.llm.runs import find_runs, periodic_runs, run_digests

SCHEMA = "doc_id long, text string"


def brute(words, least=6, exponent=4):
    """All runs: for each period, maximal stretches of words equal to those so far on; a multiple of a shorter one's is none."""
    n, runs = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            end = e + q
            part = words[i:end] if end - i >= max(least, exponent * q) else []
            if part and not any(all(part[x] == part[x + r] for x in range(len(part) - r)) for r in range(1, q)):
                runs.append((i, end - i, q))
            i = e + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    words = planted(doc_id, words_of(text))
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = best and 1000 * best[1] // best[2]
    return (doc_id, len(runs), *(best or (None, None, None)), milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def test_runs_of_random_words():
    """Few different words, so that runs of all periods nest, overlap and touch."""
    for seed in range(400):
        rng = random.Random(seed)
        docs = []
        for _ in range(rng.randint(1, 4)):
            words = []
            while len(words) < rng.randint(0, 70):
                block = [rng.randint(0, rng.choice((1, 2, 3))) for _ in range(rng.randint(1, 6))]
                words += block * rng.randint(1, 6)
            docs.append(words)
        at = np.r_[0, np.cumsum([len(d) for d in docs])]
        ids = np.array([w for d in docs for w in d], np.int64)
        for least, exponent in ((6, 4), (1, 5), (6, 3)):
            found = list(zip(*(x.tolist() for x in find_runs(ids, np.repeat(at[1:], np.diff(at)), least, exponent)), strict=True))
            want = [(s + a, s + a + n, q) for a, d in zip(at.tolist(), docs, strict=False) for s, n, q in brute(d, least, exponent)]
            assert found == want, (seed, docs)


def test_digests_on_edges(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 4, "x " + "a b c " * 5 + "a y", "É é " * 9, "a b " * 7, "a\x0bb\x0cc\rd " * 6, "A a " * 3]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["w1 w2 w3 w4 w5 " * 40 + "end", " ".join(f"u{i}" for i in range(80))]
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(None, "a a a a a a a"), (7, "same"), (7, "same")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS runs", "text AS collapsed", "doc_id AS n_words")
    found = [tuple(r) for r in run_digests(docs).collect()]
    assert sorted(found, key=str) == sorted((digest(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in found) > 20
    assert run_digests(docs.limit(0)).count() == 0


def test_texts_and_spans(spark):
    row = periodic_runs(spark.createDataFrame([(1, "so " + "no way " * 5 + "out")], SCHEMA)).first()
    assert row.n_words == 12 and [tuple(r) for r in row.runs] == [(1, 10, 2)] and row.collapsed == "so no way out"


def test_a_very_long_text(spark):
    """Half a million words, one hot word and one long period: the work stays near linear."""
    text = "a " * 200_000 + "b " + " ".join(f"w{i % 50_000}" for i in range(300_000))
    row = periodic_runs(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert [tuple(r) for r in row.runs] == [(0, 200_000, 1), (200_001, 300_000, 50_000)]


def test_query_on_the_smallest_tables(spark):
    from ledgerline.llm.queries import op12_seed_extend_runs

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 6000").collect()
    found = {r[0]: tuple(r) for r in op12_seed_extend_runs(spark, sf).collect()}
    assert all(found[r.doc_id] == digest(r.doc_id, r.text) for r in rows)
