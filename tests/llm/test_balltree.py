"""Ranked search against its definition, text by text, and the bounds of the trees against exact products."""

import math
import random
import re

import numpy as np
import pytest

from ledgerline.llm.balltree import BallTree, Best, Queries, rank_documents, search_tree

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=50):
    held = [(d, cut(t)) for d, t in docs]
    held = [(d, ts) for d, ts in held if ts]
    n_docs, total = len(held), sum(len(ts) for _, ts in held)
    df = {}
    for _, ts in held:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in set(items):
        scores = []
        for d, ts in held:
            m = 100 - 50 + (50 * len(ts) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * ts.count(t)) // (1000 * ts.count(t) + 20 * m)) for t in set(cut(text)) if t in df)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **more):
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS score", "'x' AS terms", "2 AS n")
    return sorted((tuple(r) for r in rank_documents(d, spark.createDataFrame(items, ITEMS).selectExpr("*", "3 AS rank"), **more).collect()), key=str)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)] + ["é", "Straße", "日本", "x_y", "a-b"]
    docs = [(i, " ".join(rng.choice(names[: rng.choice((5, 20, len(names)))]) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return docs, [(i, " ".join(rng.choice(names) for _ in range(rng.randint(1, 12)))) for i in range(12)]


@pytest.mark.parametrize(("seed", "n", "more"), [(1, 300, {}), (2, 900, {"sample": 100}), (3, 400, {"top": 3, "sample": 30}), (4, 500, {"most": 60, "top": 5})])
def test_ranks_are_exact(spark, seed, n, more):
    docs, items = corpus(seed, n)
    docs += [(10_000 + i, docs[i % 7][1]) for i in range(90)]  # copies: equal scores by doc_id
    assert ranked(spark, docs, items, **more) == brute(docs, items, more.get("top", 50))


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "... --"), (4, "Alpha BETA"), (4, "Alpha BETA"), (None, "alpha beta"), (5, "É É alpha"), (6, "x " * 30_000 + "alpha"), (7, "beta_beta"), (8, "ÀB àb")]
    items = [(1, "ALPHA alpha?"), (2, None), (3, " ,, "), (4, "nothing here"), (5, "beta é"), (None, "alpha"), (1, "ALPHA alpha?"), (6, "Àb"), (7, "É")]
    assert ranked(spark, docs, items) == brute([d for d in docs], [i for i in items if i[1]])
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == [] and ranked(spark, docs, [(1, None)]) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    size, words = 1000, 400
    group = np.sort(rng.integers(0, 8, size))  # documents of eight subjects, in any order
    rng.shuffle(group)
    rows = [np.unique(np.r_[rng.integers(0, 8, 3), 8 + group[d] * 49 + rng.integers(0, 49, 12)]) for d in range(size)]
    at = np.r_[0, np.cumsum([len(r) for r in rows])]
    term, doc = np.concatenate(rows), np.repeat(np.arange(size), np.diff(at))
    value = rng.integers(1, 10**6, len(term))
    weight = np.floor(rng.uniform(0, 9000, words))
    items = [np.unique(8 + g * 49 + rng.integers(0, 49, 9)) for g in range(8)]
    queries = Queries(items, weight)
    tree = BallTree(doc, term, value.astype(float), size, queries)
    exact = np.zeros((size, 8))
    for q, item in enumerate(items):
        hit = np.isin(term, item)
        np.add.at(exact[:, q], doc[hit], value[hit] * weight[term[hit]])
    for level, cuts in enumerate(tree.cuts):
        for node in range(len(cuts) - 1):
            assert (exact[tree.order[cuts[node] : cuts[node + 1]]].max(0) <= tree.bound[level][node]).all()
    best = Best(8, 10, np.zeros(8))
    search_tree(tree, queries, best, np.arange(size), np.zeros(size, bool), at, term, value)
    item, _, ids, score = best.rows()
    for q in range(8):
        want = sorted(((-s, d) for d, s in enumerate(exact[:, q].tolist()) if s > 0))[:10]
        assert [(-s, d) for s, d in zip(score[item == q].tolist(), ids[item == q].tolist(), strict=True)] == want
    alone = Best(1, 10, np.zeros(1))
    one = Queries(items[:1], weight)
    assert search_tree(BallTree(doc, term, value.astype(float), size, one), one, alone, np.arange(size), np.zeros(size, bool), at, term, value) < 3 * size / 4


def test_query_equals_sql(spark):
    import duckdb

    from ledgerline.llm.balltree import RANKS_SQL
    from ledgerline.llm.queries import op13_ball_tree_search

    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = op13_ball_tree_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(c.execute(RANKS_SQL).fetchall())
