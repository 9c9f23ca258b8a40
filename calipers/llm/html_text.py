"""Main text of pages, with boilerplate of a host found through what its pages share.

Every page is cut into blocks. A block inside an article (or main element) is the page's text unless
an inner element marks it as a menu, notice, advert, form, comment and so on; only pages without an
article fall back to the blocks that nothing marks. Either text may hold boilerplate nobody marked,
so runs of MIN_WORDS words within blocks are compared over all pages of a host:

1. Runs are winnowed: of any WINDOW neighbours the one with the smallest hash is counted, and all of a
   short block. Whole blocks from MIN_WORDS words on and parts from WINDOW + MIN_WORDS - 1 words on that
   two rows share always have one in common. Fallback texts count every run. Runs that recur are marked
   in a bitmap of fixed size, whose few false marks only cost time.
2. All runs of the blocks with a mark are counted exactly.
3. A row weighs one through the number of rows that share its text (where a quarter of its words are
   shared by fewer), so copies and near copies of a page weigh one together, however many they are.
   A run is boilerplate where the rows that have it weigh SUPPORT or more.

Blocks that such runs cover whole go, and stretches of MIN_RUN words or more; all else stays. A page
with more than three quarters boilerplate counts as a copy of its like. Nothing is ordered: a suffix
is known by the hash of its first words.

Null html is empty. Repeated rows are kept each; other columns are not read; a url without "://" has
the empty host. Texts and pages are never cut at a length.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import settle, table

#: Words that a substring has to share to count as repeated.
MIN_WORDS = 8
#: Words of a stretch that goes although its block has others; neighbouring runs of which one is counted.
MIN_RUN, WINDOW = 12, 9
#: Unlike pages that boilerplate is on; share of a page's words that tells it from another.
SUPPORT, OWN = 3, 0.25
#: Bits that tell recurring runs; words whose hashes a task keeps; numbers of 8 bytes up to which places are broadcast.
FILTER_BITS, KNOWN_WORDS, BROADCAST_NUMBERS = 1 << 25, 200_000, 2_000_000
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select xmp noembed".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("nav header footer aside form button dialog menu fieldset input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKS = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs
    sidebar aside widget footer header masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup
    social share sharing comment comments reply replies disqus respond related recommended login search toolbar pagination pager form""".split()
)
REMARKS = frozenset("comment comments reply replies disqus respond".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Parts that a class may have beside a mark and still mean it: site-nav, comments-list, but not with-sidebar.
BESIDE = frozenset(
    """site page top bottom left right main primary secondary post entry box bar block list item items link links slot unit area section wrap wrapper
    container inner outer content body holder panel row group small large mobile desktop global local sticky fixed the id""".split()
)
OPEN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
SPECIAL = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
ARTICLE, LOOSE, MARKED = 2, 1, 0


def _means(token: str) -> set[str]:
    """The marks of one whole class or id: its parts, if all of them are marks, numbers or words beside marks."""
    parts = set(re.split(r"[^a-z0-9]+", token)) - {""}
    marks = parts & MARKS
    return marks if all(p in marks or p in BESIDE or p[0].isdigit() for p in parts) else set()


def _marks(attributes: str) -> tuple[set[str], bool, bool]:
    """Marks of class and id, whether a role or state marks the element, and whether a class calls it main."""
    marks: set[str] = set()
    hard = main = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            for token in value.split():
                marks |= _means(token)
                main |= "main" in re.split(r"[^a-z0-9]+", token)
        elif name == "role":
            hard |= bool(ROLES & set(value.split()))
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hard = True
    return marks, hard, main and not marks


def _tag_end(page: str, at: int, dead: set[int]) -> int:
    """Where a tag ends whose name ends at ``at``: behind the first > outside of quotes; behind the first one, if quotes stay open.

    ``dead`` holds the opening quotes from where no end was found, so no stretch of a page is searched twice.
    """
    end, seen = page.find(">", at), []
    if page.find('"', at, end) < 0 and page.find("'", at, end) < 0:
        return end + 1
    while m := SPECIAL.search(page, at):
        if m[0] == ">":
            return m.end()
        if m.start() in dead:
            break
        seen.append(m.start())
        close = page.find(m[0], m.end())
        if close < 0:
            break
        at = close + 1
    dead.update(seen)
    return end + 1


class _Stack(list):
    """Open elements (name, kind, in comments, class mark); knows where each name and the nearest block element is."""

    def __init__(self):
        self.where: dict[str, list[int]] = {}

    def push(self, name: str, *state) -> None:
        for key in (name,) if name in INLINE else (name, ""):
            self.where.setdefault(key, []).append(len(self))
        self.append((name, *state))

    def last(self, name: str = "") -> int:
        places = self.where.get(name)
        return places[-1] if places else -1

    def cut(self, depth: int) -> None:
        while len(self) > depth:
            name = self.pop()[0]
            for key in (name,) if name in INLINE else (name, ""):
                self.where[key].pop()

    def state(self):
        return self[-1][1:] if self else (LOOSE, False, 0)


def _blocks(page: str) -> Iterator[tuple[int, str, int]]:
    """(kind, text, number of the element in an article that only its class marks, or 0) of every non-empty block.

    One pass in time in proportion to the page, whatever its nesting and however broken its markup.
    """
    stack, parts, dead = _Stack(), [], set()
    kind, remarks, soft = LOOSE, False, 0
    at, n_soft, last = 0, 0, page.rfind(">")

    def flush():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        return text

    while True:
        m = OPEN.search(page, at)
        # behind the last > only a comment can be markup
        while m and m[1] is None and m.end() > last + 1:
            at_comment = page.find("<!--", m.start())
            m = OPEN.match(page, at_comment) if at_comment >= 0 else None
        parts.append(page[at : m.start() if m else len(page)])
        if m is None:
            break
        if m[1]:
            end = page.find("-->", m.end())
            at = end + 3 if end >= 0 else len(page)
            continue
        if not m[3]:
            at = page.find(">", m.end()) + 1
            continue
        at = _tag_end(page, m.end(), dead)
        name, closing, attributes = m[3].lower(), bool(m[2]), page[m.end() : at - 1]
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE and not attributes and not closing:
            stack.push(name, kind, remarks, soft)
            continue
        marks, hard, main = _marks(attributes) if attributes and not closing else (set(), False, False)
        if name not in INLINE or hard or marks:
            if text := flush():
                yield kind, text, soft
        if closing:
            depth = stack.last(name)
            if depth >= 0 and (name not in INLINE or depth > stack.last()):
                below = stack[depth - 1][1:] if depth else (LOOSE, False, 0)
                if (below[0], below[2]) != (kind, soft) and (text := flush()):
                    yield kind, text, soft
                stack.cut(depth)
                kind, remarks, soft = stack.state()
            continue
        if name in RAW:
            if attributes.rstrip().endswith("/") and name in ("svg", "math", "object"):
                continue
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = page.find(">", end.end()) + 1 if end else 0
            at = at or len(page)
            continue
        if name not in INLINE:  # a block ends an open paragraph, an item the item before
            ends = ("p", "li") if name == "li" else ("p", "dt", "dd") if name in ("dt", "dd") else ("p", "td", "th") if name in ("td", "th") else ("p",)
            depth = stack.last()
            if depth >= 0 and stack[depth][0] in ends:
                stack.cut(depth)
                kind, remarks, soft = stack.state()
        if name in VOID:
            continue
        mine, within, of = kind, remarks or bool(marks & REMARKS), soft
        if name in ("article", "main") or main and name == "div":
            mine, of = (MARKED, 0) if within or hard else (ARTICLE, 0)
        elif name in HEADINGS and kind == MARKED and len(stack) > 1 and stack[-1][0] == "header" and stack[-2][1] == ARTICLE:
            mine, of = ARTICLE, 0  # the title in an article's own header
        elif name not in ("html", "body") and (name in DROPPED or hard or marks):
            of = 0
            if kind == ARTICLE and name not in DROPPED and not hard and not marks & REMARKS:
                of = n_soft = n_soft + 1
            mine = MARKED
        stack.push(name, mine, within, of)
        kind, remarks, soft = mine, within, of
    if text := flush():
        yield kind, text, soft


def blocks(page: str) -> list[tuple[int, str]]:
    """(ARTICLE | LOOSE | MARKED, text) of every non-empty block in page order.

    An element with most of an article's words is not marked by its class alone (reader comments are).
    """
    found = list(_blocks(page))
    if not any(soft for _, _, soft in found):
        return [(kind, text) for kind, text, _ in found]
    words: Counter[int] = Counter()
    for kind, text, soft in found:
        if soft or kind == ARTICLE:
            words[soft] += text.count(" ") + 1
    total = sum(words.values())
    return [(ARTICLE if soft and 2 * words[soft] > total else kind, text) for kind, text, soft in found]


class Hashes(dict):
    """64-bit hashes of words, kept while they are few; the same in every worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found


def grams(own: list[list[str]], host: str, known: Hashes, k: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, key, block) of every run of k words within one of a page's blocks, in page order; the key takes the host in."""
    sizes = np.array([len(w) for w in own], dtype=np.int64)
    block = np.repeat(np.arange(len(own)), sizes)
    h = np.fromiter((known[w] for words in own for w in words), np.uint64, len(block))
    n = max(0, len(h) - k + 1)
    key = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[j : n + j]
    key = (key ^ np.uint64(known[host])) * np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    at = np.flatnonzero(np.arange(n) + k <= np.cumsum(sizes)[block[:n]])
    return at, key[at].view(np.int64), block[at]


def winnowed(key: np.ndarray, block: np.ndarray, dense: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each run stands for its surroundings: the smallest key of any `window` neighbours in its block, and all of a block with fewer."""
    chosen = dense[block] | (np.bincount(block, minlength=len(dense))[block] < window)
    if len(key) >= window:
        start = np.flatnonzero(block[: len(key) - window + 1] == block[window - 1 :])
        chosen[start + np.lib.stride_tricks.sliding_window_view(key, window)[start].argmin(axis=1)] = True
    return chosen


def _read(page: str | None) -> tuple[bool, list[tuple[bool, list[str]]]]:
    """Whether a page has an article; and of every block, whether it is a candidate for the text, and its words."""
    own = blocks(page or "")
    has = any(kind == ARTICLE for kind, _ in own)
    return has, [(kind == (ARTICLE if has else LOOSE), text.split(" ")) for kind, text in own]


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, host, page, html); rows with one host and html are the same `page`."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"(?s)://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    return rows.select("id", "url", "host", F.xxhash64("host", "html").alias("page"), "html")


def prints(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key) of the winnowed runs of every row, each once a row; runs of loose blocks that may become text are all there."""

    def work(batches):
        known = Hashes()
        for batch in batches:
            out = [np.empty(0, np.int64)]
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                has, own = _read(page)
                _, key, block = grams([w for _, w in own], host, known, min_words)
                if len(key):
                    out.append(np.unique(key[winnowed(key, block, np.array([t and not has for t, _ in own]))]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], ["key"])

    return rows.select("host", "html").mapInArrow(work, "key long")


def recurring(keys: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS: every key that two rows have is in it, and few others."""
    bit = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(bit.alias("bit"))
    found = several.groupBy(F.shiftright("bit", 15).alias("bucket")).agg(F.expr("bitmap_construct_agg(bit & 32767)").alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in found.collect():  # FILTER_BITS in all
        bitmap[r["bucket"] * 4096 : r["bucket"] * 4096 + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bitmap


def outside(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", seen=None, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, id, page, host, words, blocks): the blocks to look at outside of the page itself, for runs that other pages have.

    All blocks, or with `seen` (broadcast bitmap of recurring) those with a run in it. `words` counts the
    words of the blocks that may become the page's text, or of all blocks where there is none.
    """

    def work(batches):
        known = Hashes()
        for batch in batches:
            total, looked = [], []
            for host, page in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                has, own = _read(page)
                counts = any(t for t, _ in own)
                picked = range(len(own))
                if seen is not None:
                    _, key, block = grams([w for _, w in own], host, known, min_words)
                    bit = key & (FILTER_BITS - 1)
                    hit = seen.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0
                    picked = set(block[hit & winnowed(key, block, np.array([t and not has for t, _ in own]))].tolist()) if len(key) else ()
                at, out = 0, []
                for k, (t, w) in enumerate(own):
                    if k in picked:
                        out.append({"at": at, "text": t or not counts, "words": w})
                    at += len(w)
                total.append(sum(len(w) for t, w in own if t or not counts))
                looked.append(out)
            arrays = [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(total, pa.int32()), pa.array(looked, kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "id", "page", "host", "words", "blocks"])

    kind = pa.list_(pa.struct([("at", pa.int32()), ("text", pa.bool_()), ("words", pa.list_(pa.string()))]))
    rows = _pages(pages, id_col, url_col, html_col).select(F.monotonically_increasing_id().alias("row"), "id", "page", "host", "html")
    schema = f"row long, id {pages.schema[id_col].dataType.simpleString()}, page long, host string, words int, blocks array<struct<at:int,text:boolean,words:array<string>>>"
    return rows.mapInArrow(work, schema)


def repeated(streams: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, page, words, key, place, text, n) of every run of min_words words that n > 1 rows have."""

    def work(batches):
        known = Hashes()
        for batch in batches:
            out = [[np.empty(0, np.int64)] * 4 + [np.empty(0, bool)]]
            for row, page, words, host, own in zip(*(batch.column(k).to_pylist() for k in range(5))):
                at, key, block = grams([b["words"] for b in own], host, known, min_words)
                if not len(key):
                    continue
                first = np.cumsum([0, *(len(b["words"]) for b in own)])[:-1]
                place = at + np.array([b["at"] for b in own])[block] - first[block]
                out.append([np.full(len(key), row), np.full(len(key), page), np.full(len(key), words), key, np.array([b["text"] for b in own])[block], place])
            columns = [np.concatenate([np.asarray(o[k]) for o in out[1:]]) if len(out) > 1 else np.empty(0, bool if k == 4 else np.int64) for k in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "page", "words", "key", "text", "place"])

    runs = settle(streams.select("row", "page", "words", "host", "blocks").mapInArrow(work, "row long, page long, words long, key long, text boolean, place long"))
    several = runs.select("key", "row").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return runs.join(settle(several), "key")


def weights(runs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, weight): one through the rows that share a row's text, taken where OWN of its words have fewer; near copies weigh one together."""

    def work(batches):
        for batch in batches:
            out = []
            for words, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                place, n = np.array([r["place"] for r in own]), np.array([r["n"] for r in own])
                met = np.zeros(place.max() + min_words, dtype=np.int64)
                for k in range(min_words):
                    np.maximum.at(met, place + k, n)
                met = np.sort(met[met > 0])
                at = int(words * OWN) - (words - len(met))
                out.append(1.0 if at < 0 else 1.0 / met[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["row", "weight"])

    own = runs.filter("text").groupBy("row").agg(F.first("words").alias("words"), F.collect_list(F.struct("place", "n")).alias("own"))
    return own.mapInArrow(work, "row long, weight double")


def boilerplate(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_words: int = MIN_WORDS) -> DataFrame:
    """(page, places): where runs begin that SUPPORT or more unlike pages of the host have."""
    seen = pages.sparkSession.sparkContext.broadcast(recurring(prints(_pages(pages, id_col, url_col, html_col), min_words)))
    runs = settle(repeated(outside(pages, id_col, url_col, html_col, seen, min_words), min_words))
    votes = runs.select("key", "row").distinct().join(settle(weights(runs, min_words)), "row", "left")
    cut = settle(votes.groupBy("key").agg(F.sum(F.coalesce("weight", F.lit(1.0))).alias("support")).filter(F.col("support") > SUPPORT - 0.01).select("key"))
    return settle(runs.filter("text").select("key", "page", "place").join(cut, "key").groupBy("page").agg(F.collect_set("place").alias("places")))


def without(own: list[str], at: int, covered: set[int]) -> list[str]:
    """A block's words but for its covered stretches of MIN_RUN or more, or for all of them where it is covered whole."""
    kept, k = [], 0
    while k < len(own):
        end = k
        while end < len(own) and at + end in covered:
            end += 1
        if end == k or end - k < min(MIN_RUN, len(own)):
            end = max(end, k + 1)
            kept += own[k:end]
        k = end
    return kept


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, url, text, from_article) of every page row."""

    def work(batches):
        for batch in batches:
            texts, from_article = [], []
            for page, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                has, own = _read(page)
                covered = {p + k for p in places or () for k in range(min_words)}
                at, out = 0, []
                for text, words in own:
                    if text and (kept := without(words, at, covered) if covered else words):
                        out.append(" ".join(kept))
                    at += len(words)
                texts.append("\n\n".join(out))
                from_article.append(has)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(from_article, pa.bool_())], ["id", "url", "text", "from_article"])

    places = boilerplate(pages, id_col, url_col, html_col, min_words)
    if places.agg(F.coalesce(F.sum(F.size("places") + 4), F.lit(0))).first()[0] <= BROADCAST_NUMBERS:
        places = F.broadcast(places)  # then no page moves
    rows = _pages(pages, id_col, url_col, html_col).join(places, "page", "left").select("id", "url", "html", "places")
    return rows.mapInArrow(work, f"id {pages.schema[id_col].dataType.simpleString()}, url string, text string, from_article boolean").withColumnRenamed("id", id_col)


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "from_article")
