"""HTML extraction: the article of a page, with boilerplate found by a host suffix array.

The pages of a host are token streams; a suffix array over all of them shows the long substrings that stand on distinct
pages as neighbours with a long common prefix. Here suffixes are ordered by their first RUN tokens only: suffixes equal
that far are neighbours, and grouping by (host, first RUN tokens) brings them together in pre-aggregated form, so no host is
one task. A token is covered if a repeated run of RUN tokens covers it. That covers what the whole order would: a substring of
RUN tokens or more that stands on two pages is made of runs that do, and each such run is itself such a substring.

Articles themselves repeat (copies, quoted lines), and a repeated substring of an article is boilerplate only if it stands on most
of the host. So on pages with an `article` or `main` element, of its blocks those go that are notices of the host: suffixes that
begin a block and repeat to its end, RUN tokens or more, on MANY unlike pages or more that are half of the host's. On other pages,
blocks outside of menus, adverts and the like are the main text, less the covered runs. A page of which runs cover more than half is a near copy
of others, not boilerplate, and keeps all of it: no page loses its text to its own copies.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, materialize, mix, powers, shingle_hashes
from ledgerline.llm.urlfilter import host_of

RUN = 8
MANY = 4
# Elements whose text is never shown or never main text, elements that part blocks, and words in class,
# id or role of menus, adverts and the like.
RAW = frozenset("script style noscript template iframe object svg textarea select".split())
DROP = frozenset("head title nav footer aside form button dialog menu header".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NAMES = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo consent cookie cookies footer masthead menu modal nav navbar navigation newsletter notice popup promo related search share sidebar social sponsor sponsored subscribe toolbar widget".split())
# Words that with the above still make a name of such a part, as in `comments-section`.
PARTS = frozenset("area bar block body bottom box button buttons card container content count feed footer form header icons inner item items left link links list meta outer panel posts reader right row section slot text thread title top trail unit user users wrapper".split())
# The same for elements marked as articles: a reader's comment, or the card of another article.
CARDS = frozenset("ad ads advert advertisement card comment comments promo related reply replies sponsored teaser teasers".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def _boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROP:
        return not (tag == "header" and inside)
    if not attributes or tag in ("html", "body", "main"):
        return False
    names = {w for m in _NAMED.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").lower().split()}
    pieces = [set(filter(None, re.split(r"[^a-z0-9]+", w))) for w in names]
    if tag == "article":
        return any(p & CARDS for p in pieces) or bool(_HIDDEN.search(attributes))
    # In an article a name counts only if all of its pieces say so: `related-work` may be a chapter.
    named = any(p & NAMES and (not inside or p <= NAMES | PARTS) for p in pieces)
    return named or bool(_HIDDEN.search(attributes))


def _closes_later(page: str, place: int, tag: str) -> bool:
    """Whether an element that is open here ends further on: the page has more of its end tags than of its start tags from here."""
    rest = page[place:].lower()
    return len(re.findall(rf"</{tag}\b", rest)) > len(re.findall(rf"<{tag}\b", rest))


def blocks(page: str) -> tuple[bool, list[tuple[str, str]]]:
    """Whether a page has an article with text, and its text blocks in order as (kind, text): article, other or dropped.

    Bad markup is read on as far as it goes: an article that begins ends a menu left open, an end tag without its start
    is passed over, a tag cut off by the end of the page is no text.
    """
    out: list[tuple[str, str]] = []
    held: list[str] = []
    dropped: list[str] = []  # open elements from the dropped one on
    depth, place = 0, 0

    def flush():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(("dropped" if dropped else "article" if depth else "other", text))
            held.clear()

    size = len(page)
    while place < size:
        m = _TAG.search(page, place)
        if not m:
            held.append(page[place:])
            break
        if m.start() > place:
            held.append(page[place : m.start()])
        place = m.end()
        if not m[2]:
            continue
        tag, end = m[2].lower(), bool(m[1])
        if tag in RAW and not end:
            if m[3].endswith("/"):
                continue
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, place)
            place = close.end() if close else size
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK or tag in DROP:
            flush()
        if tag in ("article", "main") and dropped and not (tag == dropped[0] and "article" in dropped) and not end and not _closes_later(page, place, dropped[0]):
            flush()
            dropped.clear()  # a menu or the like that was left open
        if tag in ("article", "main") and end and depth and dropped and tag not in dropped:
            flush()
            dropped.clear()  # what was left open inside the article ends with it
        if tag in ("article", "main") and not dropped and (end or not _boilerplate(tag, m[3], depth > 0)):
            depth = max(0, depth - 1) if end else depth + 1
        elif dropped:
            if end and tag in dropped:
                flush()
                while dropped.pop() != tag:
                    pass
            elif not end and tag not in VOID and tag in (dropped[0], "div", "ul", "section", "article"):
                dropped.append(tag)
        elif not end and tag not in VOID and _boilerplate(tag, m[3], depth > 0):
            flush()
            dropped.append(tag)
    flush()
    return any(kind == "article" for kind, _ in out), out


def _tokens(text: str) -> np.ndarray:
    """A hash for each token of a block."""
    data = np.frombuffer(text.encode(), np.uint8)
    space = data == 32
    begin = np.r_[0, np.flatnonzero(space) + 1]
    end = np.r_[np.flatnonzero(space), len(data)]
    total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(0x100000001B3, len(data)))]
    return mix((total[end] - total[begin]) * powers(pow(0x100000001B3, -1, 1 << 64), len(data))[begin])


def _whole(text: str) -> int | None:
    """The suffix from a block's begin to its end, as a hash; null under RUN tokens."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True) if text.count(" ") >= RUN - 1 else None


def parse_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, article, wholes, sizes, rest, runs): the article's blocks or null, with their whole suffixes and numbers of
    tokens; else the other blocks; and the hashes of all runs of RUN tokens outside the article (fewer tokens: the whole stream),
    block by block in page order."""

    def parse(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for page in batch.column(3).to_pylist():
                has, found = blocks(page or "")
                outside = [(k, t) for k, t in found if k != "article"]
                stream = [_tokens(t) for _, t in outside]
                article = [t for k, t in found if k == "article"]
                cols[0].append(article if has else None)
                cols[1].append([_whole(t) for t in article])
                cols[2].append([t.count(" ") + 1 for t in article])
                cols[3].append([] if has else [t for k, t in outside if k == "other"])
                cols[4].append(np.concatenate([shingle_hashes(s, RUN) for s in stream]).view(np.int64).tolist() if stream else [])
            arrays = [pa.array(c, pa.list_(t)) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *arrays], ["page_id", "url", "host", "article", "wholes", "sizes", "rest", "runs"])

    source = pages.select(F.col("page_id").cast("long"), "url", host_of(F.col("url")).alias("host"), "html")
    return source.mapInArrow(parse, "page_id long, url string, host string, article array<string>, wholes array<long>, sizes array<long>, rest array<string>, runs array<long>")


def host_notices(parsed: DataFrame) -> DataFrame:
    """(host, notices): the whole suffixes of article blocks that stand on MANY unlike pages or more, half of the host's unlike pages at
    least. Their number for each host is at most twice the blocks of a page."""
    seen = parsed.where("article is not null").select("host", F.xxhash64("article", "runs").alias("content"), F.array_distinct(F.array_compact("wholes")).alias("wholes"))
    unlike = seen.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    held = seen.select("host", "content", F.explode("wholes").alias("whole")).distinct().groupBy("host", "whole").agg(F.count("*").alias("n")).where(F.col("n") >= MANY)
    return held.join(unlike, "host").where(2 * F.col("n") >= F.col("pages")).groupBy("host").agg(F.collect_set("whole").alias("notices"))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page; text is empty if there is none, n_chars its code points.

    Null html is empty. Pages without a host are one host. Pages of equal text are one page to the repeat test, under
    whatever address, so a page is not boilerplate of its own copy. No rows give none; very long pages are read whole; extra
    columns are not read.
    """
    parsed = materialize(parse_pages(pages))
    # Article pages: their blocks, less the host's notices; a page of which these are more than half keeps all.
    notices = broadcast_if_small(materialize(host_notices(parsed)))
    bad = lambda b: F.coalesce(F.array_contains("notices", b["wholes"]), F.lit(False))
    tokens = lambda of: F.aggregate(of, F.lit(0).cast("long"), lambda n, b: n + b["sizes"])
    each = F.arrays_zip("article", "wholes", "sizes")
    whole = F.col("notices").isNull() | (2 * tokens(F.filter(each, bad)) > tokens(each))
    left = F.when(whole, F.col("article")).otherwise(F.transform(F.filter(each, lambda b: ~bad(b)), lambda b: b["article"]))
    done = parsed.where("article is not null").join(notices, "host", "left").select("page_id", "url", F.array_join(left, "\n\n").alias("text"))
    runs = parsed.select("host", F.xxhash64("article", "runs").alias("content"), F.explode(F.array_distinct("runs")).alias("run"))
    repeated = runs.groupBy("host", "run").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a < b").select("host", "run")
    # Other pages: their blocks, with the runs that repeat on the host.
    other = parsed.where("article is null").withColumn("row", F.monotonically_increasing_id())
    other = materialize(other.select("row", "page_id", "url", "host", "rest", "runs"))
    hits = other.select("row", "host", F.explode(F.array_distinct("runs")).alias("run")).join(repeated, ["host", "run"]).groupBy("row").agg(F.collect_set("run").alias("covered"))

    def uncover(batches):
        for batch in batches:
            texts = []
            for rest, covered in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                bad = np.array(covered or [], np.int64).view(np.uint64)
                kept, lost, total = [], 0, 0
                for t in rest:
                    hit = np.isin(shingle_hashes(_tokens(t), RUN), bad)
                    words = t.split(" ")
                    gone = np.zeros(len(words), bool)
                    for at in np.flatnonzero(hit):
                        gone[at : at + RUN] = True
                    lost, total = lost + int(gone.sum()), total + len(words)
                    kept.append(" ".join(w for w, g in zip(words, gone, strict=True) if not g))
                texts.append("\n\n".join(rest if 2 * lost > total else [x for x in kept if x]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rest = other.join(hits, "row", "left").select("page_id", "url", "rest", "covered").mapInArrow(uncover, "page_id long, url string, text string")
    return done.unionByName(rest).withColumn("n_chars", F.length("text").cast("long"))
