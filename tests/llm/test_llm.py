"""The ten operators and the pipeline against brute force, with nulls, empty and long texts, ties and repeated rows."""

import collections
import html
import math
import random
import re
import zlib

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.llm import common, decontam, htmltext, jaccard, langid, linededup, lmscore, packing, quality, sharding, urlfilter  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    base = " ".join(words(120, 1))
    lines = "\n".join(" ".join(words(9, 100 + k)) for k in range(14))
    out = [None, "", "   \n\t", "one", "two words", base, base, base.upper(), base.replace(" ", "  \n"), base + " tail end", " ".join(base.split()[4:]), lines, "head line here\n" + lines, lines, " ".join(words(9000, 7)), "ß é ü #*$ 你好 words"]
    for k in range(25):
        out.append("\n".join(" ".join(words(12, 1000 * k + j)) for j in range(1 + k % 7)))
    near = words(200, 55)
    for k in range(12):
        r = random.Random(k)
        copy = list(near)
        for _ in range(k):
            copy[r.randrange(200)] = f"x{r.randrange(9)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], "s", None if t is None else len(t), "z") for i, t in enumerate(texts)]
    rows.append((*rows[5][:5], "other"))  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = WORD.findall(low(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(texts):
    sets = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(texts))]


def test_sharding_is_even_and_gapless(spark, docs, data):
    got = sharding.shard_by_bytes(docs, 4).toPandas()
    assert len(got) == docs.count() and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    by_id = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got.itertuples():
        assert r.size == len(by_id[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(by_id[r.doc_id].encode())
    whole = spark.read.parquet(f"{data}/documents.parquet")
    got = sharding.shard_by_bytes(whole, 8).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 2 * got["size"].max()


def test_sharding_splits_a_hot_group_and_keeps_small_ones(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "the same text").otherwise(F.concat(F.lit("text number "), F.floor(F.col("id") / 8).cast("string"))).alias("text"))
    got = sharding.shard_by_bytes(rows.repartition(6), 10).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() < 0.03 * sums.mean()
    group = got.merge(rows.toPandas(), on="doc_id")
    spread = group[group.text != "the same text"].groupby("text").shard.nunique()
    assert (spread == 1).mean() > 0.95 and group[group.text == "the same text"].shard.nunique() >= 5


def test_sharding_of_nothing(empty):
    assert sharding.shard_by_bytes(empty, 4).count() == 0


def test_language_held_out(spark, data):
    d = spark.read.parquet(f"{data}/documents.parquet")
    got = langid.predict_languages(d).toPandas().merge(d.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 20 and (held.lang_pred == held.lang).mean() > 0.95
    assert got.score.between(0, 1).all()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.itertuples())


def test_language_mixture_and_edges(spark, data):
    d = spark.read.parquet(f"{data}/documents.parquet")
    langs, table = langid.train(d)
    pick = {lang: d.where(F.col("lang") == lang).where("length(text) between 1500 and 4000").first().text for lang in ("en", "de")}
    odd = [(1, None), (2, ""), (3, "123 !! \u00b2 \u00bd"), (4, pick["en"] + "\n" + pick["de"]), (5, "你好"), (6, pick["de"])]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(odd, "doc_id long, text string"), langs, table).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert {"en", "de"} <= set(got[4].languages) and 0.2 < got[4].score < 0.8
    assert got[5].lang_pred in langs and got[5].score < 0.6 and got[6].score > 0.8 and got[6].lang_pred == "de"


def test_language_does_not_depend_on_neighbours(spark):
    """A second language like the first is no gain, a third one is, whether or not a neighbour gains from two."""
    r, rand = np.random.default_rng(3), random.Random(3)
    first, other = (r.normal(-9, 3, 1 << 17) for _ in range(2))
    table = np.stack([first, first, other], 1).astype(np.float32)
    pool = ["".join(rand.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(600)]
    gram, begins, _ = langid._grams([" ".join(pool)], 17)
    order = np.argsort(np.add.reduceat((other - first)[gram], begins))
    a, c = [pool[k] for k in order[:80]], [pool[k] for k in order[-80:]]
    rows = [(1, " ".join(a + c[-20:])), (2, " ".join(a + c))]
    got = lambda rows: {x.doc_id: (x.lang_pred, round(x.score, 9), tuple(x.languages)) for x in langid.identify(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), ["a", "b", "c"], table).collect()}
    alone, beside = got(rows[:1])[1], got(rows)[1]
    assert alone == beside and "c" in alone[2]


def test_language_proportions_equal_plain_em():
    """Expectation-maximisation word by word, with languages shut out of some documents."""
    r = np.random.default_rng(9)
    sizes = [1, 4, 30, 7]
    like = np.exp(r.normal(0, 2, (sum(sizes), 3)))
    doc, first = np.repeat(np.arange(4), sizes), np.r_[0, np.cumsum(sizes)[:-1]]
    allowed = np.array([[1, 1, 1], [1, 0, 1], [1, 1, 1], [0, 1, 0]], float)
    mixed, loss = langid._em(like, doc, first, allowed, 12)
    for d in range(4):
        own = like[first[d] : first[d] + sizes[d]].tolist()
        share = [a / sum(allowed[d]) for a in allowed[d]]
        for _ in range(12):
            parts = [[x * y for x, y in zip(w, share, strict=True)] for w in own]
            share = [sum(p[k] / sum(p) for p in parts) / len(own) for k in range(3)]
        assert mixed[d] == pytest.approx(share, abs=1e-9)
        assert loss[d] == pytest.approx(sum(math.log(sum(x * y for x, y in zip(w, share, strict=True))) for w in own), rel=1e-9)


def test_language_of_nothing(empty, docs):
    assert langid.predict_languages(empty).count() == 0
    assert langid.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_lm_scores_prefer_the_target(spark, data):
    data = data.replace("sf0.001", "sf0.01")  # two hundred documents are too few for two models
    d, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    got = lmscore.cross_entropy_difference(d, labels).toPandas().merge(labels.toPandas(), on="doc_id", how="left")
    assert len(got) == d.count()
    assert got[got.quality == 1].difference.median() < got[got.quality == 0].difference.median()


def test_lm_against_brute_force(spark):
    texts = {1: "a b a b c", 2: "a b c d", 3: "x y z x y", 4: None, 5: "a"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 1, 0), (3, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lmscore.cross_entropy_difference(d, labels).collect()}
    size = 1 + len({x for t in texts.values() if t for x in t.split()})  # and the class of rare words

    def loss(doc, side):
        others = [t.split() for k, t in texts.items() if t and k != doc and (k in (1, 2)) == (side == 1)]
        w, p = collections.Counter(x for t in others for x in t), collections.Counter(x for t in others for x in zip(t, t[1:], strict=False))
        total, t, out = sum(w.values()), texts[doc].split(), 0.0
        for k, x in enumerate(t):
            one = (w[x] + 1) / (total + size)
            both = one if k == 0 else (p[t[k - 1], x] + 4 * one) / (max(w[t[k - 1]], p[t[k - 1], x]) + 4)
            out -= math.log(both)
        return out / len(t)

    for doc in (1, 2, 3, 5):
        assert got[doc].target_loss == pytest.approx(loss(doc, 1), rel=1e-5) and got[doc].background_loss == pytest.approx(loss(doc, 0), rel=1e-5)
    assert got[4].n_tokens == 0 and got[4].difference is None


def test_lm_keeps_all_pairs_apart(spark):
    """More distinct pairs than 2**20 (each in one text) share no count, and frequent ones are counted right."""
    r = random.Random(6)
    texts = {k: " ".join(["often", "met"] * 9 + [f"w{r.randrange(10**7)}" for _ in range(30_000)]) for k in range(40)}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 40, 2)], "doc_id long, quality int, toxic int")
    side = [collections.Counter(), collections.Counter()]
    pairs = [collections.Counter(), collections.Counter()]
    for k, t in texts.items():
        w = t.split()
        side[1 - k % 2].update(w)
        pairs[1 - k % 2].update(zip(w, w[1:], strict=False))
    size = 1 + len(side[0].keys() | side[1].keys())
    got = {x.doc_id: x for x in lmscore.cross_entropy_difference(d, labels).collect()}
    for k in (0, 1):
        w = texts[k].split()
        own, both = collections.Counter(w), collections.Counter(zip(w, w[1:], strict=False))
        for m, have in ((1, got[k].target_loss), (0, got[k].background_loss)):
            less, out = int(m == 1 - k), 0.0
            total = sum(side[m].values()) - less * len(w)
            for i, x in enumerate(w):
                one = (side[m][x] - less * own[x] + 1) / (total + size)
                if i == 0:
                    out -= math.log(one)
                    continue
                c = pairs[m][w[i - 1], x] - less * both[w[i - 1], x]
                out -= math.log((c + 4 * one) / (max(side[m][w[i - 1]] - less * own[w[i - 1]], c) + 4))
            assert have == pytest.approx(out / len(w), rel=1e-9)


def test_lm_keeps_frequent_words_and_pairs(spark):
    """With a share of 2 %, rare words are one class and rare pairs fall back on their word."""
    r = random.Random(8)
    texts = {k: " ".join(r.choice("a" * 20 + "b" * 20 + "c" * 10 + "abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(60)) for k in range(20)}
    d = spark.createDataFrame([*texts.items(), (20, ""), (21, None)], "doc_id long, text string").withColumn("target", F.lit("own")).repartition(3)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 20, 3)], "doc_id long, quality int, toxic int")
    words_ = collections.Counter(x for t in texts.values() for x in t.split())
    keep = {x for x, n in words_.items() if n >= 0.02 * 1200}
    seqs = {k: [x if x in keep else "" for x in t.split()] for k, t in texts.items()}
    pairs = collections.Counter(p for s in seqs.values() for p in zip(s, s[1:], strict=False))
    frequent = {p for p, n in pairs.items() if n >= 0.02 * 1200}
    assert 2 < len(keep) < 20 and 3 < len(frequent)
    got = {x.doc_id: x for x in lmscore.cross_entropy_difference(d, labels, 0.02).collect()}
    for k in range(20):
        for side, have in ((1, got[k].target_loss), (0, got[k].background_loss)):
            others = [s for j, s in seqs.items() if j != k and (j % 3 == 0) == (side == 1)]
            w, p = collections.Counter(x for s in others for x in s), collections.Counter(x for s in others for x in zip(s, s[1:], strict=False) if x in frequent)
            out = 0.0
            for i, x in enumerate(seqs[k]):
                one = (w[x] + 1) / (sum(w.values()) + len(keep) + 1)
                both = p[seqs[k][i - 1], x] if i else 0
                out -= math.log(one if i == 0 else (both + 4 * one) / (max(w[seqs[k][i - 1]], both) + 4))
            assert have == pytest.approx(out / 60, rel=1e-9)
    assert got[20].difference is None and got[21].n_tokens == 0 and len(got) == 22
    assert lmscore.cross_entropy_difference(d.limit(0), labels).count() == 0


def test_near_duplicates_equal_brute_force(docs, texts):
    sets, root = classes(texts)
    for r in jaccard.near_duplicates(docs).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id]), r


def test_near_duplicates_in_large_buckets(spark):
    """Enough near copies for blocks and leaders: a chain of texts, of which only neighbours link."""
    r = random.Random(4)
    stream = [f"t{r.randrange(10**6)}" for _ in range(1500)]
    texts = [" ".join(stream[k : k + 60]) for k in range(0, 1400, 3)] + [" ".join(["common"] * 4 + stream[k : k + 30]) for k in range(0, 900, 20)]
    base = stream[:300]
    for k in range(330):
        copy = list(base)
        copy[k % 290] = f"n{k}"
        texts.append(" ".join(copy))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, root = classes(texts)
    got = jaccard.near_duplicates(d.repartition(3)).toPandas().set_index("doc_id").component_id
    assert [got[k] for k in range(len(texts))] == root


def degrees(texts):
    sets = [frozenset(shingles(t)) for t in texts]
    different = list(set(sets))
    link = lambda a, b: a != b and 100 * len(a & b) >= 80 * len(a | b)
    count = {a: sum(link(a, b) for b in different) for a in different}
    return [count[s] if s else 0 for s in sets]


def test_near_duplicates_count_all_links(spark, docs, texts, monkeypatch):
    """Groups of near copies of which all, or only some, link with each other."""
    base = words(300, 77, 10**6)
    near = [" ".join([*base[:k], f"n{k}", *base[k + 1 :]]) for k in range(0, 240, 3)]
    sliding = words(400, 78, 10**6)
    near += [" ".join(sliding[k : k + 150]) for k in range(0, 250, 4)] + [" ".join(base), near[0], near[1].upper()]
    few = words(200, 79, 10**6)
    near += [" ".join([*few[:k], "x", *few[k + 1 :]]) for k in (5, 25, 50)]
    d = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string").repartition(3)
    want = degrees(near)
    links = lambda d: {r.doc_id: r.links for r in jaccard.near_duplicates(d).collect()}
    assert links(d) == dict(enumerate(want)) and want[-3:] == [2, 2, 2]
    monkeypatch.setattr(jaccard, "MEMBERS", 9)
    assert links(d) == dict(enumerate(want))
    assert links(docs) == dict(enumerate(degrees(texts)))


@pytest.mark.parametrize("bucket", [1, 4, 256])
def test_near_duplicates_whatever_the_blocks(spark, monkeypatch, bucket):
    """Sizes at the edge of the bands (1968 of 2460 shingles), and hot keys in parts, with small and with large blocks."""
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "HOT", 5)
    long = words(2464, 81, 10**6)
    texts = [" ".join(long), " ".join(long[:1972])]
    base = words(60, 82, 10**6)
    texts += [" ".join([*base[:k], f"n{k}", *base[k + 1 :]]) for k in range(1, 60)] + [" ".join([*base[:k], f"n{k}", f"m{k}", *base[k + 1 :]]) for k in range(20, 50, 3)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = jaccard.near_duplicates(d).toPandas().set_index("doc_id")
    assert list(got.loc[range(len(texts)), "component_id"]) == classes(texts)[1] and got.component_id[1] == 0
    assert list(got.loc[range(len(texts)), "links"]) == degrees(texts)


def test_linked_sizes_are_two_bands_apart_at_most(spark):
    d = spark.range(1, 60_001).select("id", F.floor(F.col("id") * 5 / 4).alias("large"))
    d = d.select("id", (jaccard.size_band("large") - jaccard.size_band("id")).alias("apart"))
    assert d.where("id = 1968").first().apart <= 2 and d.where("apart > 2").count() == 0


def test_near_duplicates_of_nothing(empty):
    assert jaccard.near_duplicates(empty).count() == 0


def test_signature_tree_loses_no_pair():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 4000).astype(np.uint64)
    sets = []
    for k in range(60):
        base = r.choice(pool, int(r.integers(3, 400)), replace=False)
        sets += [np.unique(base), np.unique(r.choice(base, max(1, int(len(base) * r.uniform(0.8, 1))), replace=False))]
    order = np.lexsort((np.arange(len(sets)), [len(s) for s in sets]))
    sets = [sets[k] for k in order]
    n, label = np.array([len(s) for s in sets], np.int32), np.arange(len(sets))
    tree = jaccard._tree(n, label, [np.frombuffer(jaccard._bitmap(s), np.uint64) for s in sets])
    found = set(jaccard.dual_traverse(tree, tree, True, (n, n), (label, label)))
    true = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert true and true <= {(min(p), max(p)) for p in found} and len(found) < 3 * len(true) + 60


PAGE = '<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/x">Menu item</a></nav><div class="ad">Buy now</div><article><h1>Head &amp; tail</h1><p>First\n  one <b>bold<br>x</b></p><p>It&#39;s &lt;fine&gt;</p><div class="comments"><p>a reader</p></div></article><footer>&copy; me</footer></body></html>'


def test_html_article():
    has, found = htmltext.blocks(PAGE)
    assert has and [t for k, t in found if k == "article"] == ["Head & tail", "First one bold x", "It's <fine>"]
    assert htmltext.blocks("<nav>open menu<article><p>kept") == (True, [("dropped", "open menu"), ("article", "kept")])
    assert htmltext.blocks("<article></article><p>the body") == (False, [("other", "the body")])
    kept = '<article><div class="related-work">a</div><p id="search-method">b</p><section class="comment-on-law">c</section><p>d <math>x</math></p>'
    assert [t for _, t in htmltext.blocks(kept)[1]] == ["a", "b", "c", "d x"]
    gone = '<article><p>a</p><div class="comments-section">b</div><div class="x related">c</div><ul id="social-links"><li>d</ul>'
    assert [t for k, t in htmltext.blocks(gone)[1] if k == "article"] == ["a"]
    assert htmltext.blocks("plain <b>text") == (False, [("other", "plain text")])
    assert htmltext.blocks("<p>a<script>var x='</p>';</script>b<!-- c --><p") == (False, [("other", "ab")])


def test_html_articles_that_are_none():
    """Readers' comments and cards of other articles are no article, wherever they stand."""
    main = lambda page: [t for k, t in htmltext.blocks(page)[1] if k == "article"]
    assert main('<article><p>a</p><section class="comments"><article class="comment">Reader says no.</article></section><p>b</p></article>') == ["a", "b"]
    assert main('<section class="comments"><article class="comment">Reader says no.<article>reply</article></article></section><article>a</article>') == ["a"]
    assert main('<div class="sidebar"><article class="teaser">card</article></div><article>a<p>b</article>') == ["a", "b"]
    assert main("<div class='sidebar'><article>card</article></div><nav><article>menu</article></nav><main>a</main>") == ["a"]
    for name in ("ad-slot", "breadcrumb-trail", "social-share-buttons", "user-comments", "comment-thread"):
        assert main(f'<article>a<div class="{name}">b</div><p>c</article>') == ["a", "c"]
    assert main('<article>a<div class="ad">open</article><article>b</article>') == ["a", "b"]


def test_html_near_copies_keep_their_text(spark):
    long = " ".join(f"a{k}" for k in range(60))
    rows = [(1, f"<p>{long}</p>"), (2, f"<p>{long} extra</p>"), (3, "<p>short text here</p>"), (4, "<p>short text here</p><p>" + " ".join(f"b{k}" for k in range(30)) + "</p>")]
    d = spark.createDataFrame([(k, f"http://h.org/{k}", h) for k, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract_text(d).collect()}
    assert got[1] == long and got[2] == long + " extra" and got[3] == "short text here"


def test_html_runs_repeat_on_a_host(spark):
    notice = " ".join(f"notice{k}" for k in range(10))
    own = [" ".join(words(15, 70 + k, 10**6)) for k in range(3)]
    rows = [(k, f"http://h.org/{k}", f"<body><div>{notice}</div><p>{own[k]}</p></body>", "x") for k in range(3)]
    rows += [(6, "http://h.org/copy", rows[2][2], "x")]  # a copy of a page is no reason to take its text away
    rows += [(3, "http://else.org/", f"<p>{notice}</p>", "x"), (4, None, None, "x"), (5, "http://h.org/a", PAGE, "x"), (0, *rows[0][1:])]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = collections.defaultdict(set)
    for r in htmltext.extract_text(d).collect():
        got[r.page_id].add(r.text)
        assert r.n_chars == len(r.text)
    assert [got[k] for k in range(3)] == [{x} for x in own] and got[6] == {own[2]} and got[3] == {notice} and got[4] == {""}
    assert got[5] == {"Head & tail\n\nFirst one bold x\n\nIt's <fine>"}
    assert htmltext.extract_text(d.limit(0)).count() == 0


def test_html_notices_in_articles(spark):
    """A block of an article that repeats on half of the host's unlike pages is a notice; quoted lines, short lines and near copies stay."""
    notice, quoted, long = (" ".join(f"{w}{k}" for k in range(n)) for w, n in (("notice", 10), ("quote", 10), ("long", 60)))
    own = [" ".join(words(20, 170 + k, 10**6)) for k in range(6)]
    body = [[own[k], *([quoted] if k < 2 else []), "read on"] for k in range(6)]
    page = lambda *p: "<article>" + "".join(f"<p>{x}</p>" for x in p) + "</article>"
    rows = [(k, f"http://h.org/{k}", page(*b, *([notice] if k < 5 else []))) for k, b in enumerate(body)]
    rows += [(10, "http://else.org/", page(own[0], notice))] + [(20 + k, f"http://near.org/{k}", page(long, f"copy {k}")) for k in range(5)] + [(30, "http://h.org/copy", rows[0][2])]
    got = {r.page_id: r.text for r in htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {k: "\n\n".join(b) for k, b in enumerate(body)} | {10: f"{own[0]}\n\n{notice}", 30: "\n\n".join(body[0])} | {20 + k: f"{long}\n\ncopy {k}" for k in range(5)}
    assert got == want


def test_html_on_pages(spark, data):
    p = spark.read.parquet(f"{data}/pages.parquet")
    truth = {}
    for r in p.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", body)]
        truth[r.page_id] = "\n\n".join(x for x in parts if x)
    assert {r.page_id: r.text for r in htmltext.extract_text(p).collect()} == truth


def test_columns_of_the_caller_do_not_matter(spark, docs):
    """Extra columns, under names that the operators use themselves, with nulls, an empty, a long and a repeated text."""
    d = docs.where("doc_id in (0, 1, 2, 3, 5, 12, 14, 15, 16)").select("doc_id", "text", "lang")
    names = "_d _t _w _f _u _c _m size key slot shard at n sid t words target side piece length ids label links kept lang_pred score held_out item_id begin text_hash n_words html".split()
    more = d.withColumns({c: F.lit("own") for c in names})
    labels = spark.createDataFrame([(5, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(words(120, 1)[:20]))], "item_id long, text string")
    rows = lambda x: sorted(map(repr, x.collect()))
    for run in (
        lambda x: sharding.shard_by_bytes(x, 3).select("doc_id", "size", "text_crc32"),
        langid.predict_languages,
        lambda x: lmscore.cross_entropy_difference(x, labels),
        lambda x: decontam.contamination(x, bench),
        quality.quality_rules,
        lambda x: packing.pack_documents(x).groupBy("doc_id").agg(F.sum("length").alias("n")),
        jaccard.near_duplicates,
    ):
        plain = rows(run(d))
        assert plain and rows(run(more)) == plain
    page = spark.createDataFrame([(1, "http://x.net/es/1", PAGE), (1, "http://x.net/es/1", PAGE), (2, None, None), (3, "http://h.org/", "<p>" + "long words " * 40_000)], "page_id long, url string, html string")
    clash = page.withColumns({c: F.lit("own") for c in "_u _c _m _to host path rule said text article rest runs row component n_chars _n".split()})
    for run in (htmltext.extract_text, urlfilter.judge_urls):
        assert rows(run(clash)) == rows(run(page)) and len(rows(run(page))) == 4


def test_banded_distance():
    def plain(a, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(a, 1):
            now = [i]
            for j in range(1, len(t) + 1):
                now.append(min(row[j - 1] + (t[j - 1] != x), row[j] + 1, now[-1] + 1))
            row = now
        return min(row)

    r = random.Random(3)
    for _ in range(150):
        a = bytes(r.choice(b"abcd") for _ in range(r.randint(20, 50)))
        b = list(a)
        for _ in range(r.randint(0, 5)):
            k = r.randrange(len(b))
            b[k : k + 1] = [[r.choice(b"abcd")], [], [b[k], r.choice(b"abcd")]][r.randrange(3)]
        t = bytes(r.choice(b"xyz") for _ in range(r.randint(0, 6))) + bytes(b) + b"xyz"
        assert decontam.banded_distance(np.frombuffer(a, np.uint8), np.frombuffer(t, np.uint8), 3)[0] == min(plain(a, t), 4)


def test_decontamination(spark):
    items = [" ".join(words(25, 500 + k, 10**5)) for k in range(4)] + [None, "short"]
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    edited = items[1].replace("w", "v", 4)
    noise = " ".join(words(300, 9, 10**5))
    rows = [(0, noise), (1, f"{noise}\n{items[0].upper()}  {noise}"), (2, edited), (3, f"x {items[2][:60]} y"), (4, None), (5, ""), (6, items[3].replace(" ", "\n\t") + " " + items[0]), (6, noise), (7, "short")]
    got = decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 0), (2, 1), (6, 3), (6, 0), (7, 5)}
    assert {r.edits for r in got if r.doc_id == 2} == {4} and {r.edits for r in got if r.doc_id != 2} == {0}
    assert decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), b.limit(0)).count() == 0


def test_decontamination_against_edit_distance(spark):
    """Items of 3 to 400 bytes with up to one edit more than their budget, against all places of all texts; in parts too."""

    def nearest(item, text):
        a, t = np.frombuffer(item.encode(), np.uint8), np.frombuffer(text.encode(), np.uint8)
        row, step = np.zeros(len(t) + 1, np.int64), np.arange(len(t) + 1)
        for i, x in enumerate(a, 1):
            now = np.r_[i, np.minimum(row[:-1] + (t != x), row[1:] + 1)]
            row = np.minimum.accumulate(now - step) + step
        return int(row.min())

    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(r.randrange(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items, rows = [], []
    for size in [3, 5, 9, 10, 12, 13, 19, 20, 25, 29, 36, 38, 40, 41, 49, 50, 51, 62, 63, 90, 400]:
        item = text(size)[:size].strip()
        items.append(item)
        for edits in range(int(len(item) * 0.08) + 2):
            own = list(item)
            for k in r.sample(range(len(own)), edits):
                own[k] = r.choice(["", "z", own[k] + "y"])
            rows.append(f"{text(5)} {''.join(own)} {text(5)}")
    rows += [" ".join(x.split()) for x in (items[0] + "q", "q" + items[1], items[2], " ".join(items))]
    rows = [" ".join(x.split()) for x in rows]
    want = set()
    for d, t in enumerate(rows):
        for k, item in enumerate(items):
            if (f" {item} " in f" {t} ") if len(item) < 10 else nearest(item, t) <= int(len(item) * 0.08):
                want.add((d, k))
    b = spark.createDataFrame([*enumerate(items), (0, items[0]), (99, ""), (98, None)], "item_id long, text string").withColumn("end", F.lit("own"))
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("item_id", F.lit("own")).repartition(2)
    for most in (decontam.BENCH_BYTES, 200):
        got = decontam.contamination(d, b, most=most)
        assert {(x.doc_id, x.item_id) for x in got.collect()} == want and got.count() == len(want) > 60
    sums = [x.agg(F.sum(F.octet_length("text"))).first()[0] for x in decontam.benchmark_parts(b, 200)]
    assert len(sums) > 4 and sum(x > 200 for x in sums) == 1  # the item of 400 bytes is a part alone


def test_decontamination_finds_all_leaks(spark, data):
    d, b = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    norm = lambda t: " ".join(low(t).split())
    items = {r.item_id: norm(r.text) for r in b.collect()}
    true = {(r.doc_id, k) for r in d.collect() for k, t in items.items() if t in norm(r.text)}
    got = {(r.doc_id, r.item_id) for r in decontam.contamination(d, b).collect()}
    assert true <= got and len(got) <= len(true) + 1


def base(t):
    t = t or ""
    w = WORD.findall(t)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    own = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(own) - len(set(own)), len(covered), failed


def test_quality_base_counts(spark, docs, data):
    more = spark.createDataFrame([(900, "a b c d e f a b c d e g a b c d e"), (901, "x y " * 40), (902, "l\nl\n \n \nl #<>"), (903, "\x0ba\x0c\x1cb c  d\r\n")], "doc_id long, text string")
    whole = docs.select("doc_id", "text").union(more).union(spark.read.parquet(f"{data}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    whole = whole.withColumn("lang", F.lit("en"))
    true = {r.doc_id: base(r.text) for r in whole.collect()}
    for r in quality.quality_rules(whole).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == true[r.doc_id], r.doc_id
        assert not (r.base_failed and r.kept)


def brute_kept(rows, char_limit=0.14, word_limit=0.23, certain=0.3, least=20):
    """The verdict of each row (text, lang): histograms, mean shares of each language, least distances."""
    common = quality.COMMON_WORDS

    def shares(t):
        n, chars, symbols = len(WORD.findall(t)), sum(map(len, WORD.findall(t))), sum(c in "#*$%&|<>" for c in t)
        bins = [sum(bool(re.fullmatch(c, x)) for x in t) for c in ("[a-z]", "[A-Z]", "[0-9]", "[.,;:'-]")] + [len(t) - chars, symbols]
        bins.append(max(len(t) - sum(bins), 0))
        held = collections.Counter(w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w in common)
        words_ = [held[w] for w in common]
        words_.append(max(n - sum(words_), 0))
        return n, chars, [np.array(b) / max(sum(b), 1) for b in (bins, words_)]

    def distance(p, q):
        m = (p + q) / 2
        kl = lambda x: float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])))
        return math.sqrt(max((kl(p) + kl(q)) / 2, 0))

    own = [shares(t or "") for t, _ in rows]
    langs = sorted({lang for _, lang in rows if lang})
    means = [[np.mean([s[k] for (n, _, s), (_, x) in zip(own, rows, strict=True) if x == lang and n >= least], 0) for k in (0, 1)] for lang in langs]
    out = []
    for (n, chars, s), (t, _) in zip(own, rows, strict=True):
        c, w = (min(distance(s[k], m[k]) for m in means) for k in (0, 1))
        far = n >= least and ((c > char_limit + 0.8 / math.sqrt(chars + 1) and w > word_limit) or c > certain)
        out.append(not base(t)[-1] and not far)
    return out


def test_quality_kept_equals_brute_force(spark, data):
    odd = ["#$% " * 30, "QWERTY ZXCV " + " ".join(f"{k}A{k}" for k in range(60)), None, "", "the of and " * 3, " ".join(f"x{k} the of" for k in range(40))]
    d = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang").union(spark.createDataFrame([(9000 + k, t, None) for k, t in enumerate(odd)], "doc_id long, text string, lang string"))
    rows = d.collect()
    want = dict(zip([r.doc_id for r in rows], brute_kept([(r.text, r.lang) for r in rows]), strict=True))
    assert {r.doc_id: r.kept for r in quality.quality_rules(d).collect()} == want and 0 < sum(want.values()) < len(want)


def test_quality_verdicts(spark, data, empty):
    d, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet").toPandas()
    got = quality.quality_rules(d).toPandas().merge(labels, on="doc_id")
    assert got[got.quality == 1].kept.mean() > 0.9 and got[got.quality == 0].kept.mean() < 0.4
    assert quality.quality_rules(empty).count() == 0


def test_js_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x, y: sum(a * math.log2(a / b) for a, b in zip(x, y, strict=True) if a)
    lit = lambda v: F.array(*map(F.lit, v))
    r = spark.range(1).select(quality.js_distance(lit(p), lit(q)).alias("a"), quality.js_distance(lit(p), lit(p)).alias("b")).first()
    assert r.a == pytest.approx(math.sqrt((kl(p, m) + kl(q, m)) / 2)) and r.b == 0


def test_url_verdicts(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://WWW.Example.com/en/1?q#f", None), (2, "https://a.example.com/en/2", None), (3, "http://x.net/es/3", None), (4, "http://x.net/de/4", None), (5, None, None), (6, "no scheme", None),
        (7, "http://x.org/a", link.format("http://y.net/fr/z")), (8, "http://www.x.org/a.html?utm=1", None), (9, "http://p.org/b", '<meta http-equiv="refresh" content="0; url=http://x.net/fr/1">' + link.format("http://www.example.com/en/5")),
        (10, "http://other.com", None), (11, "http://other.com/", None), (12, "http://evilexample.com/en/", None), (13, "http://q.org/c", link.format("/d")), (14, "http://q.org/d", link.format("http://x.net/es/9")), (1, "http://WWW.Example.com/en/1?q#f", None),
    ]
    got = {r.page_id: r for r in urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    verdicts = {k: (r.rule, r.verdict) for k, r in got.items()}
    assert verdicts[1] == ("www.example.com/en/", "allow") and verdicts[2] == ("example.com/en/", "block") and verdicts[3] == ("net/es/", "block")
    assert verdicts[4] == verdicts[5] == verdicts[6] == (None, "allow")
    assert verdicts[7] == (None, "block") and verdicts[8] == (None, "allow")  # an alias of a blocked target; its variant only with forms
    varied = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), forms=True)
    assert {r.verdict for r in varied.where("page_id in (7, 8)").collect()} == {"block"}
    assert verdicts[9] == (None, "allow")  # one target blocked, one allowed: allow takes precedence
    assert verdicts[10] == (None, "allow") and verdicts[11] == ("com/", "allow") and verdicts[12] == ("com/", "allow")
    assert verdicts[13] == verdicts[14] == (None, "block")
    assert (got[1].host, got[1].path, got[5].host, got[6].path) == ("www.example.com", "/en/1", "", "")
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_url_sql(spark):
    import duckdb

    rows = [(k, u, h) for k, (u, h) in enumerate([("http://x.org/a", '<link href=http://y.net/fr/z rel="canonical">'), ("http://www.x.org/a.html?u", None), ("http://q.org/c", "<meta HTTP-EQUIV=refresh content='0;url=/d'>"), ("http://q.org/d", "<LINK rel=canonical href='http://x.net/es/9'>"), (None, None), ("", "x"), ("http://WWW.example.com/en/", "y")])]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = d.toPandas()  # noqa: F841
    want = duckdb.sql(urlfilter.VERDICTS_SQL).fetchall()
    assert {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(d).collect()} == {tuple(None if x is None else x for x in r) for r in want}
    assert sum(r[4] == "block" for r in want) == 3


def test_url_edges_that_are_none(spark):
    """A URL in a query, links in comments and scripts, and look-alike addresses join nothing; the SQL says the same."""
    import duckdb

    link = '<link rel="canonical" href="{}">'
    html = [link.format("go?u=http://b.net/es/z"), "<!-- " + link.format("http://d.net/es/") + " -->", "<script>x='" + link.format("http://d.net/es/") + "'</script>", "<!-- a -->" + link.format("http://d.net/es/") + "<!-- b", None, None]
    urls = ["http://a.net/1", "http://a.net/2", "http://a.net/3", "http://a.net/4", "http://foo.net/es", "http://foo.net/es/"]
    d = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(zip(urls, html, strict=True))], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlfilter.judge_urls(d).collect()}
    assert {k for k, v in got.items() if v == "block"} == {3, 5}
    pages = d.toPandas()  # noqa: F841
    assert {r[0]: r[4] for r in duckdb.sql(urlfilter.VERDICTS_SQL).fetchall()} == got


def test_url_relative_targets(spark):
    """Relative targets meet a blocked page however they are written; the SQL says the same."""
    import duckdb

    link, base = '<link rel="canonical" href="{}">', '<base href="{}">'
    wanted = "http://x.net/es/d/t"
    pages = {
        1: ("http://x.net/de/q/a", link.format("../../es/d/t")), 2: ("http://x.net/de/a", link.format("../es/./d/x/../t")), 3: ("http://x.net", link.format("es/d/t")), 4: ("http://o.org/a", base.format("http://x.net/es/d/") + link.format("t")),
        5: ("http://x.net/b", base.format("/es/d/") + link.format("t?u=1")), 6: ("http://o.org/c", link.format("http:&#x2F;/x.net/es/d/t?a&amp;b")), 7: ("http://o.org/d", link.format("mailto:me@x.net")), 8: ("http://o.org/e", link.format("?p=2")),
        9: ("http://o.org/f", link.format("other") + link.format(wanted)), 10: ("http://o.org/g", "<meta http-equiv=refresh content='0; url=//x.net/es/d/t'>"), 11: ("http://x.net/de/h", link.format("../../../../es/d/t#x")), 12: ("http://o.org/i", link.format("")), 13: ("http://o.org/j", base.format("") + link.format("#k")), 14: (None, link.format("t")),
    }
    d = spark.createDataFrame([(k, u, h) for k, (u, h) in pages.items()], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlfilter.judge_urls(d).collect()}
    assert {k for k, v in got.items() if v == "block"} == {1, 2, 3, 4, 5, 6, 9, 10, 11}
    pages = d.toPandas()  # noqa: F841
    assert {r[0]: r[4] for r in duckdb.sql(urlfilter.VERDICTS_SQL).fetchall()} == got
    paths = {"/a/b/..": "/a/", "/a/./b": "/a/b", "/..": "/", "/a/..b": "/a/..b", "": "", "/a/b/.": "/a/b/"}
    r = spark.createDataFrame([(k,) for k in paths], "p string").select("p", urlfilter.without_dots(F.col("p")).alias("w")).collect()
    assert {x.p: x.w for x in r} == paths


def test_connected_components(spark):
    r = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(120)] + [(5, 5)]
    up = {k: k for e in edges for k in e}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for a, b in edges if a != b for k in (a, b)}


def test_encoder_is_loaded_once_in_a_process():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert packing._encoder(*files) is packing._encoder(*files)


def test_packing_round_trip(spark, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(500, "a <|endoftext|> b"), (501, "\u0085 x y 9999999 'll")], "doc_id long, text string"))
    cut = packing.pieces(more, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), 512, with_ids=True)
    got = packing.pack(cut, 512).toPandas()
    texts = {r.doc_id: r.text for r in more.collect()}
    for doc, g in got.drop_duplicates(["doc_id", "piece"]).groupby("doc_id"):
        g = g.sort_values("piece")
        ids = [*own.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        assert [x for part in g.ids for x in part] == ids and list(g.start) == list(np.cumsum([0, *g.length[:-1]]))
        assert (g.length.iloc[1:] == 512).all()
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in g.itertuples())
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == list(np.cumsum([0, *g.length[:-1]])) and g.length.sum() <= 512
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 512) + 1
    assert packing.pack_documents(empty).count() == 0


def test_minimum_bin_slack():
    r = random.Random(2)
    for _ in range(30):
        counts = collections.Counter(r.randint(1, 40) for _ in range(r.randint(1, 60)))
        used = collections.Counter()
        for times, lengths in packing.minimum_bin_slack(dict(counts), 40):
            assert sum(lengths) <= 40 and times > 0
            for x in lengths:
                used[x] += times
        assert used == counts
        room = r.randint(0, 60)
        sums = {0}
        for x, n in counts.items():
            sums |= {s + k * x for s in sums for k in range(n + 1)}
        got = packing.fullest(dict(counts), room)
        assert sum(got) == max(s for s in sums if s <= room) and not collections.Counter(got) - counts


def brute_dedup(spark, rows, long_words=50):
    """(doc_id, text, removed lines) of rows (doc_id, text hash, text), chunk by chunk in plain Python."""
    split = [(d, h, t.split("\n")) for d, h, t in rows]
    pairs = sorted({p for _, _, x in split for p in zip(x, x[1:], strict=False)})
    table = spark.createDataFrame(pairs or [("", "")], "a string, b string")
    rolling = {(r.a, r.b): r.h for r in table.select("a", "b", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()}
    links = collections.Counter(p for _, _, x in split for p in zip(x, x[1:], strict=False))
    is_long = lambda x: len(WORD.findall(x)) >= long_words
    chunks = {}
    for d, h, x in split:
        n = [links[p] if links[p] > 1 else 0 for p in zip(x, x[1:], strict=False)]
        at = lambda k, n=n: n[k] if 0 <= k < len(n) else 0
        weak = [bool(c) and (c < at(k - 1) or c < at(k + 1)) for k, c in enumerate(n)]
        key = [rolling[p] for p in zip(x, x[1:], strict=False)]
        inner = lambda k, n=n, weak=weak: 0 < k < len(n) - 1 and n[k - 1] == n[k] == n[k + 1] > 0 and not any(weak[k - 1 : k + 2])
        glue = [bool(n[k]) and not weak[k] and not (inner(k) and key[k] < key[k - 1] and key[k] <= key[k + 1]) for k in range(len(n))]
        own, begin = [], 0
        for k in range(len(x)):
            if k == len(x) - 1 or not glue[k]:
                own.append((begin, k + 1))
                begin = k + 1
        chunks[d, h] = [(s, e) for s, e in own if e - s > 1 and sum(bool(WORD.search(y)) for y in x[s:e]) > 1] + [(k, k + 1) for k, y in enumerate(x) if is_long(y)]
    first = {}
    for d, h, x in sorted(split):
        for s, e in sorted(chunks[d, h]):
            first.setdefault("\n".join(x[s:e]), (d, h, s))
    out = []
    for d, h, x in split:
        gone = {k for s, e in chunks[d, h] if first["\n".join(x[s:e])] != (d, h, s) for k in range(s, e)}
        out.append((d, "\n".join(y for k, y in enumerate(x) if k not in gone), len(gone)))
    return out


def test_line_dedup(spark, docs, data, empty):
    whole = docs.select("doc_id", "text").union(spark.read.parquet(f"{data}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    clash = ("_d", "_t", "_gone", "_row", "chunk", "removed_lines", "i", "key")
    whole = whole.withColumns({c: F.lit("own") for c in clash})
    true = sorted(brute_dedup(spark, [(r.doc_id, r.h, r.text) for r in whole.where("text is not null").withColumn("h", F.xxhash64("text")).collect()]))
    got = linededup.dedup_lines(whole)
    assert sorted((r.doc_id, r.text, r.removed_lines) for r in got.where("text is not null").collect()) == true
    assert got.where("text is null").count() == whole.where("text is null").count() and any(x[2] for x in true)
    assert got.columns == ["doc_id", "text", *("input_removed_lines" if c == "removed_lines" else c for c in clash), "removed_lines"]
    assert all(got.where(F.col(c if c != "removed_lines" else "input_removed_lines") != "own").isEmpty() for c in clash)
    assert linededup.dedup_lines(empty).count() == 0


def test_line_dedup_of_planted_passages(spark):
    """Passages of one to six lines and over 50 words go everywhere but at first; also where two of them meet in one text."""
    passages = [[" ".join(words(60 // n + 1, 300 + 10 * n + k, 10**6)) for k in range(n)] for n in range(1, 7)]
    own = lambda k: [" ".join(words(12, 9000 + 50 * k + j, 10**6)) for j in range(2 + k % 3)]
    rows, want = [], {}
    for k in range(24):
        mine, held = own(k), passages[k % 6] + (passages[(k + 1) % 6] if k >= 12 else [])
        rows.append((k, "\n".join([*mine[:1], *held, *mine[1:], "a common short line"])))
        want[k] = "\n".join([*mine[:1], *(held if k < 6 else []), *mine[1:], "a common short line"])
    rows.append((99, "\n".join(own(99))))
    got = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {**want, 99: rows[-1][1]}


def test_line_chunks_resist_shifts(spark):
    lines = [" ".join(words(6, 40 + k)) for k in range(40)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["new first", *lines])), (3, "\n".join([*lines[10:30], "new last"]))]
    got = {r.doc_id: (r.text, r.removed_lines) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("new first", 40), 3: ("new last", 20)}


def brute_contaminated(rows, items, rate=0.08):
    """Ids of rows (id, text) in which an item stands within its budget: edit distances to all places of all texts."""
    norm = lambda t: " ".join(low(t).split(" ")).encode()
    fold = lambda t: norm(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").strip(" "))
    items = {fold(t) for t in items} - {b""}
    gap = b"\0" * (int(rate * max(map(len, items))) + 2)
    texts = [fold(t) for _, t in rows]
    owner = np.repeat(np.arange(len(rows)), [len(t) + len(gap) for t in texts])
    t, bad = np.frombuffer(b"".join(x + gap for x in texts), np.uint8), set()
    step = np.arange(len(t) + 1, dtype=np.int32)
    for item in items:
        row = np.zeros(len(t) + 1, np.int32)
        for i, x in enumerate(item, 1):
            now = np.r_[np.int32(i), np.minimum(row[:-1] + (t != x), row[1:] + 1)]
            row = np.minimum.accumulate(now - step) + step
        bad |= {rows[k][0] for k in owner[np.flatnonzero(row[1:] <= int(rate * len(item)))]}
    return bad


def test_pipeline_stages_against_brute_force(spark, data, docs):
    d = spark.read.parquet(f"{data}/documents.parquet").unionByName(docs.where("doc_id > 30").withColumn("doc_id", F.col("doc_id") + 10_000).drop("extra"))
    d = d.withColumn("source", F.coalesce("source", F.lit("s")))
    (_, q), (_, lines), (_, near), (_, clean), (_, pack) = corpus_pipeline.STAGES
    rows = lambda x: sorted(tuple(r) for r in x.collect())
    kept = common.materialize(q(spark, d, data))
    whole = d.collect()
    stay = [r.doc_id for r, keep in zip(whole, brute_kept([(r.text, r.lang) for r in whole]), strict=True) if keep]
    assert rows(kept) == rows(d.where(F.col("doc_id").isin(stay)))
    cut = common.materialize(lines(spark, kept, data))
    assert cut.columns == kept.columns
    done = brute_dedup(spark, [(r.doc_id, r.h, r.text) for r in kept.withColumn("h", F.xxhash64("text")).collect()])
    want = {k: t for k, t, n in done if not n or t.strip(" ")}
    assert {r.doc_id: r.text for r in cut.collect()} == want and cut.where("n_chars <> length(text)").count() == 0
    held = sorted((r.doc_id, r.text) for r in cut.collect())
    _, root = classes([t for _, t in held])
    one = common.materialize(near(spark, cut, data))
    assert [r[0] for r in rows(one)] == [k for i, (k, t) in enumerate(held) if root[i] == i]
    left = common.materialize(clean(spark, one, data))
    bad = brute_contaminated([(r.doc_id, r.text) for r in one.collect()], [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()])
    assert bad and rows(left) == [r for r in rows(one) if r[0] not in bad]
    assert {r.doc_id for r in pack(spark, left, data).collect()} == {r.doc_id for r in left.collect()}


def test_pipeline_near_stage_keeps_one_of_repeated_rows(spark, docs, data):
    out = corpus_pipeline.near(spark, docs, data).toPandas()
    assert (out[out.doc_id == 5].shape[0], out.doc_id.isin([6, 7, 8, 9]).sum()) == (1, 0)
    assert out.text.isna().sum() == 1


def test_pipeline_of_nothing(spark, empty, data):
    d = empty.drop("extra")
    for _, stage in corpus_pipeline.STAGES:
        d = common.materialize(stage(spark, d, data))
    assert d.count() == 0


def test_links_inside_classes_do_not_reach_the_last_components(spark, monkeypatch):
    """A class of near copies goes on as one node: the last components see pairs of classes, not the links inside them."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(120):
        words = base.copy()
        words[rng.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(words)))
    seen = []
    plain = common.connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda edges: seen.append(edges.where("a <> b").distinct().count()) or plain(edges))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.component_id, r.links) for r in got} == {(0, 119)}
    assert seen[0] >= 119 and seen[1] < 119


def test_leaders_of_one_class_are_met_once(spark):
    """Eight leaders of a set's own class are met no more, those of another class twice for each two classes."""
    meets = spark.createDataFrame([(s, lead, 10 + lead) for s in range(100, 140) for lead in (*range(1, 9), 50, 51, 52)], "sid long, lead long, c long")
    labels = spark.createDataFrame([(s, 1) for s in (*range(1, 9), *range(100, 139))] + [(s, 50) for s in (50, 51, 52)], "node long, component long")
    got = sorted(map(tuple, jaccard.class_meetings(meets, labels).collect()))
    assert got == [(7, 139), (8, 139), (51, 139), (52, 100), (52, 101), (52, 139)]


def test_lm_counts_rare_words_whatever_the_blocks(spark, monkeypatch):
    """Two texts share pairs that are far under 2**-21 of all words; small blocks and one block tell the same."""
    filler = " ".join(["often", "met"] * 75_000)
    texts = {k: filler for k in range(40)} | {200: "rare words meet here", 201: "rare words meet here", 202: "other seldom things stand", 203: "one two three four"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(200, 1, 0), (202, 1, 0)], "doc_id long, quality int, toxic int")
    whole = {r.doc_id: r for r in lmscore.cross_entropy_difference(d, labels).collect()}
    assert whole[201].difference < whole[203].difference - 1 and len(whole) == 44
    monkeypatch.setattr(lmscore, "BLOCK", 1 << 20)
    small = {r.doc_id: r for r in lmscore.cross_entropy_difference(d, labels).collect()}
    assert all(small[k].difference == pytest.approx(whole[k].difference, rel=1e-9) for k in texts)


def test_lm_counts_travel_as_blocks(spark, monkeypatch):
    """Between blocks and ranges there are values of many keys, not rows of one: few bytes a key; small ranges tell the same."""
    r = random.Random(8)
    texts = {k: " ".join(f"w{int(r.paretovariate(0.4)) % 10**6}" for _ in range(4_000)) for k in range(60)}
    d = spark.createDataFrame([(k, t, k % 2) for k, t in texts.items()], "doc_id long, text string, target int").repartition(3)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(1, 60, 2)], "doc_id long, quality int, toxic int")
    whole = {x.doc_id: x for x in lmscore.cross_entropy_difference(d, labels).collect()}
    monkeypatch.setattr(lmscore, "SPAN", 1 << 17)
    monkeypatch.setattr(lmscore, "BLOCK", 1 << 18)
    small = {x.doc_id: x for x in lmscore.cross_entropy_difference(d, labels).collect()}
    assert all(small[k] == whole[k] for k in texts)
    blocks = lmscore._in_blocks(d)
    totals, words, size = lmscore.block_totals(blocks)
    got = totals.toPandas()
    assert got["range"].nunique() > 5 and len(got) <= blocks.count() * got["range"].nunique()
    assert got.totals.map(len).sum() < 4 * got.n.sum() and got.n.sum() > 50_000
    assert words.tolist() == [120_000, 120_000] and size == len({w for t in texts.values() for w in t.split()})


def test_sets_that_no_leader_joins_meet_their_closest(spark, monkeypatch):
    """Near copies that no leader joined: their links make no row for each pair, and all count."""
    r = random.Random(9)
    base, more = [f"b{k}" for k in range(300)], [f"m{k}" for k in range(500)]

    def copy(words, k):
        at = r.randrange(len(words))
        return " ".join([*words[:at], f"x{k}", *words[at + 1 :]])

    texts = [copy(base, k) for k in range(60)] + [copy(base + more, k) for k in range(100, 112)]
    met, verify = [], jaccard.verify

    def counted(docs, sets, pairs):
        met.append(pairs.count())
        return verify(docs, sets, pairs)

    monkeypatch.setattr(jaccard, "verify", counted)
    monkeypatch.setattr(jaccard, "MEETS", 0)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in jaccard.near_duplicates(d).collect()}
    assert [got[k].links for k in range(72)] == [59] * 60 + [11] * 12
    assert {got[k].component_id for k in range(60)} == {0} and {got[k].component_id for k in range(60, 72)} == {60}
    assert sum(met) < 6 * 72, met
