"""Main text of web pages, with the repeated runs of words of a host's pages.

A page is cut into blocks, each with its place: inside the article, inside a
menu, footer, advert and the like, or elsewhere. The words of all blocks of a
page, one behind the other, are its token stream. Blocks inside the article are
kept whole, because articles may quote each other; blocks in a menu, footer and
so on go; of all other blocks the words covered by a run of ``RUN`` words that
also stands on another page of the host go and the unique ones stay.

Spark finds the runs over whole hosts, however large: only runs that touch a
block of the third kind can take words away, so these are aggregated first; the
ones met on a single page are then looked up among all other runs. A suffix
array over the streams of a host, cut at ``RUN`` words, gives the same answer in
memory (``main_texts``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.substring_dedup import deep_nodes
from streetlens.llm.tables import stored, text_batches
from streetlens.llm.words import U64, WORDS, distinct, mix, range_hash, word_chunks
from streetlens.operators.joins import BROADCAST_ROWS, lookup_join

RUN = 8  # words of a repeated run, at least
SPAN_ROWS = 20_000  # pages whose covered words are broadcast, at most

ARTICLE, CHROME, OTHER = 0, 1, 2

# Element names and attribute words.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noframes".split())
SKIPPED = set(
    "head script style noscript template iframe object svg canvas audio video form button select option textarea input "
    "fieldset nav footer aside menu dialog figure-menu annotation annotation-xml".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSE_P = BLOCKS - set("body html caption dd dt li tbody td tfoot th thead tr legend summary figcaption".split())
CLOSE_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("table ul ol dl td th article main section div body html".split())
CHROME_WORDS = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement advertising banner sponsor "
    "sponsored promo promotion cookie cookies consent notice notices popup modal overlay comment comments disqus reply replies social share "
    "sharing related recommended breadcrumb breadcrumbs newsletter subscribe subscription signup login search toolbar pagination pager "
    "copyright widget widgets skip".split()
)
# what a class or id may add to such a word without changing what it names
PLACES = set(
    "list container wrapper wrap box block bar area section slot unit link links item items button buttons icon icons inner outer left right "
    "top bottom primary secondary main mobile desktop post posts result results panel group row column col content site page global form thread js".split()
)
TITLES = {"header", "masthead"}  # inside an article they hold its title
NEGATIONS = set("has no not with without hide".split())  # has-sidebar, layout-no-sidebar: words on the layout
CHROME_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _named_chrome(value: str, in_article: bool) -> bool:
    """Whether one of the names of a class or id is that of a menu, advert and the like.

    What a name is about stands at its end, before words for places: a
    cookie-banner, a sidebar-left, but not a share-price. Inside an article a
    name counts only if it says nothing else: comment-list, but not court-notice.
    """
    for name in value.split():
        words = [w.lower() for w in WORD.findall(name)]
        named = [k for k, w in enumerate(words) if w in CHROME_WORDS and (k == 0 or words[k - 1] not in NEGATIONS)]
        if not named or not all(w in PLACES for w in words[named[-1] + 1 :]):
            continue
        if not in_article or (not TITLES.intersection(words) and all(w in CHROME_WORDS or w in PLACES for w in words)):
            return True
    return False


def _chrome(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element starts something left out: 0 no, 1 by element, state or role, 2 by its class or id alone."""
    if tag in SKIPPED:
        return 1
    if tag == "header":
        return int(not in_article)
    if not attributes or tag in ("html", "body"):
        return 0
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", given.get("style", ""), re.I):
        return 1
    if given.get("role", "").lower() in CHROME_ROLES:
        return 1
    if tag == "main":
        return 0
    return 2 * any(_named_chrome(given.get(k, ""), in_article) for k in ("class", "id"))


def page_blocks(source: str) -> Iterator[tuple[int, str]]:
    """(place, text) of the page's blocks in order; texts have decoded references and single spaces.

    What an element's class or id says does not reach into an article or main
    element below it, unless an article is around both. Elements within a line
    that are left out, such as a button or a hidden span, do not end its block.
    """
    # open elements, whether each starts something left out, and the marks by class or id that it set aside
    stack: list[tuple[str, int, int]] = []
    inside = articles = left_out = named = 0
    hushed = [0, 0, 0]  # open elements within a line that are left out, by kind of mark
    pieces: list[str] = []
    out: list[tuple[int, str]] = []

    def close_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                out.append((CHROME if left_out or named else ARTICLE if inside else OTHER, text))

    def add(text: str) -> None:
        if not hushed[1] and not (hushed[2] and named):
            pieces.append(text)

    def pop(to: int) -> None:
        nonlocal inside, articles, left_out, named
        while len(stack) > to:
            name, chrome, aside = stack.pop()
            hushed[chrome] -= name not in BLOCKS
            left_out -= chrome == 1
            named += aside - (chrome == 2)
            inside -= name in ("article", "main")
            articles -= name == "article"

    at, end = 0, len(source)
    while at < end:
        m = TAG.search(source, at)
        if m is None:
            add(html.unescape(source[at:]))
            break
        if m.start() > at:
            add(html.unescape(source[at : m.start()]))
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if tag == "br":
            pieces.append(" ")
            continue
        if m[1]:
            if tag in BLOCKS:
                close_block()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag in BLOCKS:
            close_block()
        if tag in VOID:
            continue
        if tag in CLOSE_P or tag in CLOSE_SAME:
            closes = CLOSE_SAME.get(tag, set()) | ({"p"} if tag in CLOSE_P else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in closes:
                    pop(k)
                    break
                if stack[k][0] in SCOPE:
                    break
        if m[3].rstrip().endswith("/") and tag in ("svg", "math", "iframe", "object"):
            continue
        chrome = _chrome(tag, m[3], inside > 0)
        aside = named if tag in ("article", "main") and not articles else 0
        stack.append((tag, chrome, aside))
        hushed[chrome] += tag not in BLOCKS
        left_out += chrome == 1
        named += (chrome == 2) - aside
        inside += tag in ("article", "main")
        articles += tag == "article"
        if tag in RAW:  # its content is no markup
            stop = re.compile(f"</{tag}[\\s/>]", re.I).search(source, at)
            at = stop.start() if stop else end
    close_block()
    return iter(out)


def repeated_words(words: list[str], page: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which words of the streams are covered by a run of ``run`` words that stands on at least two pages."""
    covered = np.zeros(len(words), dtype=bool)
    if len(words) < run:
        return covered
    ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1]
    start = np.flatnonzero(page[: len(page) - run + 1] == page[run - 1 :])
    if not len(start):
        return covered
    node = deep_nodes(ids, start, run)
    order = np.lexsort((page[start], node))
    n, p = node[order], page[start][order]
    first = np.flatnonzero(np.r_[True, n[1:] != n[:-1]])
    shared = np.repeat(p[np.append(first[1:], len(p)) - 1] > p[first], np.diff(np.append(first, len(n))))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start[order][shared], 1)
    np.add.at(change, start[order][shared] + run, -1)
    return np.cumsum(change[:-1]) > 0


def _kept(own: list[tuple[int, str]], covered: np.ndarray) -> str:
    """The page's text, given which of its words are covered."""
    kept, at = [], 0
    for place, text in own:
        words = text.split(" ")
        if place == ARTICLE:
            kept.append(text)
        elif place == OTHER:
            unique = " ".join(w for w, c in zip(words, covered[at : at + len(words)]) if not c)
            if unique:
                kept.append(unique)
        at += len(words)
    return "\n".join(kept)


def main_texts(pages: list[str | None]) -> list[str]:
    """Main text of each page of one host, in memory."""
    blocks = [list(page_blocks(p or "")) for p in pages]
    words, page, first = [], [], [0]
    for k, own in enumerate(blocks):
        for _, text in own:
            words += text.split(" ")
        page += [k] * (len(words) - first[-1])
        first.append(len(words))
    covered = repeated_words(words, np.array(page, np.int64)) if words else np.zeros(0, bool)
    return [_kept(own, covered[lo:hi]) for own, lo, hi in zip(blocks, first[:-1], first[1:])]


def _blocks(batches):
    """Blocks of each page: a digit for each place, and the texts, one a line."""
    for batch in batches:
        blocks = [list(page_blocks(p or "")) for p in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in ("page_id", "url", "_host", "_uid")), pa.array(["".join(str(p) for p, _ in own) for own in blocks], pa.string()),
             pa.array(["\n".join(t for _, t in own) for own in blocks], pa.string())],
            names=["page_id", "url", "_host", "_uid", "_places", "_texts"],
        )


def _runs(other: bool):
    """Runs of ``RUN`` words: those that touch a block elsewhere, with their first word, or the others, once a page."""

    def run(batches):
        for batch in batches:
            host, uid = batch["_host"].to_numpy().view(U64), batch["_uid"].to_numpy()
            places = batch["_places"].to_pylist()
            for i, j, words in word_chunks(batch["_texts"]):
                row, n = words.row, len(words.starts)
                if n < RUN:
                    continue
                # a line break or a row's end ends a block; a row without blocks counts as one
                block = np.cumsum(words.data == 0x0A)[words.starts] + row
                elsewhere = np.frombuffer("".join(p or str(CHROME) for p in places[i:j]).encode(), np.uint8)[block] == ord(str(OTHER))
                before = np.append(0, np.cumsum(elsewhere))
                start = np.flatnonzero((row[: n - RUN + 1] == row[RUN - 1 :]) & ((before[RUN:] > before[:-RUN]) == other))
                if not len(start):
                    continue
                r = row[start]
                key = mix(range_hash(words.hashes(), WORDS, start, start + RUN) ^ mix(host[i:j][r]))
                if other:
                    at = [pa.array((start - words.first[r]).astype(np.int32))]
                else:
                    at, (key, r) = [], distinct(key, r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(uid[i:j][r]), *at], names=["run", "_uid", "at"][: 2 + other]
                )

    return run


def repeated_runs(blocks: DataFrame) -> DataFrame:
    """(_uid, at): first words of the runs touching a block elsewhere that stand on two pages of the host, at least."""
    streams = blocks.select("_host", "_uid", "_places", "_texts")
    other = streams.filter(F.col("_places").contains(str(OTHER))).mapInArrow(_runs(True), "run long, _uid long, at int")
    met = stored(other.groupBy("run").agg(F.min("_uid").alias("u0"), F.max("_uid").alias("u1")), "met")
    once = met.filter("u0 = u1").select("run", "u0")
    rest = streams.mapInArrow(_runs(False), "run long, _uid long")
    seen = lookup_join(rest, once, ["run"], "inner", known_rows=once.limit(BROADCAST_ROWS + 1).count())
    repeated = met.filter("u0 < u1").select("run").unionByName(seen.filter("_uid <> u0").select("run").distinct())
    return lookup_join(other, repeated, ["run"], "inner").select("_uid", "at")


def _extract(batches):
    for batch in batches:
        texts = []
        for places, lines, at in zip(batch["_places"].to_pylist(), batch["_texts"].to_pylist(), batch["_at"]):
            own = list(zip(map(int, places), lines.split("\n")))
            change = np.zeros(lines.count(" ") + len(own) + 1, np.int64)
            if at.is_valid:
                lo = at.values.to_numpy()
                np.add.at(change, lo, 1)
                np.add.at(change, lo + RUN, -1)
            texts.append(_kept(own, np.cumsum(change[:-1]) > 0))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    A null or empty page has an empty text. Pages without a host in their url
    are one host of their own. Rows that are equal in all three columns are one
    page. Runs hashed alike (64 bits) count as equal. n_chars counts code points.
    Runs several jobs; the blocks are stored in the shared folder.
    """
    text_batches(pages)
    host = F.coalesce(F.lower(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    pages = pages.withColumns({"_host": F.xxhash64(host), "_uid": F.xxhash64("page_id", "url", "html")})
    ids = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string"
    blocks = stored(pages.mapInArrow(_blocks, f"{ids}, _host long, _uid long, _places string, _texts string"), "blocks")
    spans = repeated_runs(blocks).groupBy("_uid").agg(F.collect_set("at").alias("_at"))
    found = lookup_join(blocks, spans, ["_uid"], max_rows=SPAN_ROWS).select("page_id", "url", "_places", "_texts", "_at")
    return found.mapInArrow(_extract, f"{ids}, text string").withColumn("n_chars", F.char_length("text").cast("long"))
