"""Pairwise ranking: features against a direct count, the fit against gradient descent, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm.common import text_buffers
from ledgerline.llm.pairwise import _KIND, KINDS, SHAPES, classify_quality, features, fit_bradley_terry, preference_pairs, quantile_cut, sample_labels

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def direct(text):
    raw = (text or "").encode()
    pairs = np.zeros((KINDS, KINDS))
    for a, b in zip(raw, raw[1:], strict=False):
        pairs[_KIND[a], _KIND[b]] += 1 / (len(raw) - 1)
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    low = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    n = max(len(words), 1)
    triples = list(zip(low, low[1:], low[2:], strict=False))
    lines = [x for x in (tuple(re.findall(rb"[^\x20\x09-\x0D]+", line)) for line in re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw).split(b"\n")) if x]
    shapes = [
        not words,
        np.log1p(len(words)) / 10,
        np.log1p(sum(map(len, words)) / n),
        len(set(low)) / n,
        sum(a == b for a, b in zip(low, low[1:], strict=False)) / n,
        1 - len(set(triples)) / max(len(triples), 1),
        len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(w[:1].isupper() for w in words) / n,
        sum(len(re.findall(rb"[A-Z]", w)) > 1 and not re.search(rb"[a-z]", w) for w in words) / n,
        sum(len(w) < 3 for w in words) / n,
    ]
    return np.r_[pairs.ravel(), np.array(shapes, float)]


def test_features_against_a_direct_count():
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "AB", "É x", "a\nb\nA\n\nb c\nb  c", "x x x x", "one TWO three. One two THREE!", "| a | b\t| c\x0bd"]
    texts += ["".join(rng.choice("aAbB  \n.!#é1") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    found = features(*text_buffers(pa.array(texts)))
    np.testing.assert_allclose(found, [direct(t) for t in texts], atol=1e-12)
    assert found.shape[1] == KINDS * KINDS + len(SHAPES)


def test_fit_is_the_least_loss():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0.5, 1, (60, 4)), rng.normal(-0.3, 1, (25, 4))
    w = fit_bradley_terry(good, bad, rounds=3, ridge=0.01)
    a, b = preference_pairs(60, 25, 3)
    assert len(a) == 180 and sorted(a.tolist()) == sorted([*range(60)] * 3)
    x, v = good[a] - bad[b], np.zeros(4)
    for _ in range(20_000):
        v -= 0.5 * (0.01 * v - (1 / (1 + np.exp(x @ v))) @ x / len(x))
    np.testing.assert_allclose(w, v, atol=1e-5)


def test_cut_is_between_the_labels():
    assert quantile_cut(np.array([3.0, 4, 5, 9]), np.array([1.0, 2, 0])) == 2.5
    assert quantile_cut(np.array([1.0]), np.array([0.0])) == 0.5
    assert quantile_cut(np.full(90, 8.0), np.r_[np.zeros(59), 8.0]) == 4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify_quality(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert len(rows) > 800
    good, bad = (rows[rows.quality == q] for q in (1, 0))
    assert good.predicted.mean() > 0.98 and bad.predicted.mean() < 0.02
    assert np.mean([(good.score > s).mean() for s in bad.score]) > 0.99  # one such text of 136 has nothing but normal sentences


def test_edges(spark):
    def texts(doc_id):
        return f"The cat sat here, and number {doc_id} slept well." if doc_id % 3 else f"BUY!! NOW!! {doc_id} $$$ ###"

    rows = [(i, texts(i)) for i in range(200)] + [(500, None), (501, ""), (502, " \n"), (None, texts(1)), (3, texts(3)), (600, "word " * 100_000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score", "2 AS quality", "'x' AS predicted")
    given = [(i, int(i % 3 > 0), 0) for i in range(200)] + [(3, 0, 0), (4, None, 0), (5, 7, 0), (None, 1, 0), (999, 1, 0), (501, 0, 0)]
    labels = spark.createDataFrame(given, LABELS).selectExpr("*", "'b' AS text")
    found = [tuple(r) for r in classify_quality(docs, labels).collect()]
    assert len(found) == len(rows) and all(0 <= s <= 1 and p == int(s >= 0.7) for _, _, s, p in found)
    assert all(h == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2) for d, h, _, _ in found)
    assert [(d, s) for d, _, s, p in found if d is not None and d < 200 and p != int(d % 3 > 0)] == []
    assert len({s for d, _, s, _ in found if d == 3}) == 1
    # Labels of the held-out fold teach nothing.
    turned = labels.withColumn("quality", F.expr("CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END"))
    assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in classify_quality(docs, turned).collect())
    none = classify_quality(docs, labels.where("quality = 1")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert classify_quality(docs.limit(0), labels).count() == 0
    assert sample_labels(labels, 20).groupBy("quality").count().where("count > 45").count() == 0
