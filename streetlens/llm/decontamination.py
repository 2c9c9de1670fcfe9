"""Benchmark decontamination with suffix arrays over shards of the training texts.

A shard is a slice of an Arrow batch: its texts as word numbers, one after the
other, with a stop behind each. Its suffixes are ordered by their first three
words at once and then by prefix doubling among those still tied. Every suffix
of the benchmark is looked up by binary search, which gives the range of
places that start with the same window, and the longest verbatim match. A text
is in one shard as a whole, so nothing is shuffled.

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS`` words; one
pass over the texts is made for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.tables import stored, text_batches
from streetlens.llm.words import U64, WORDS, Words, range_hash, word_chunks

WINDOW = 10
SHARD_BYTES = 4 << 20
SHARD_WORDS = 1 << 20  # a longer text is cut into overlapping segments
BLOCK_WORDS = 1 << 20
PIECE_WORDS = 1 << 15  # a longer item is cut into pieces that overlap by a window less one word
BITS = 21  # of a word's number in a shard

# bytes between words; capitals count as letters, they are lower-cased
GAP = np.ones(256, dtype=bool)
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

HITS = "array<struct<lo: int, n: int>>"


class Block:
    """Some benchmark pieces: hashes of their words, and the distinct windows with the items that have them."""

    def __init__(self, items: list[str], starts: list[int], pieces: list[np.ndarray], window: int):
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.items = np.unique(np.array(items, dtype=object)) if items else np.zeros(0, object)
        self.words = np.concatenate(pieces) if pieces else np.zeros(0, U64)
        item = np.searchsorted(self.items, np.array(items, dtype=object)) if items else np.zeros(0, np.int64)
        self.depth = int(sizes.max(initial=1))
        base = np.cumsum(sizes) - sizes
        width = np.minimum(sizes, window)
        many = sizes - width + 1
        row = np.repeat(np.arange(len(sizes)), many)
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        self.at = base[row] + at  # of every window: its place in words, its width, the words left in its piece
        self.width = width[row]
        self.left = sizes[row] - at
        self.item, self.place = item[row], at + np.array(starts, dtype=np.int64)[row] if len(row) else at
        # a window that several items have is looked up once
        name = range_hash(self.words, WORDS, self.at, self.at + self.width)
        _, self.one, self.same = np.unique(name, return_index=True, return_inverse=True)
        pair = np.unique(self.same.astype(np.int64) * max(1, len(self.items)) + self.item)
        self.owner = pair % max(1, len(self.items))  # items of window w: owner[owners[w]:owners[w + 1]]
        self.owners = np.searchsorted(pair // max(1, len(self.items)), np.arange(len(self.one) + 1))


class SuffixArray:
    """The suffixes of some texts, ordered by their first ``depth`` words at least."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, depth: int):
        self.names, ids = np.unique(hashes, return_inverse=True)
        texts = len(first) - 1
        self.row = np.repeat(np.arange(texts), np.diff(first) + 1)
        self.base = first[:-1] + np.arange(texts)  # where each text starts, stops counted
        size = len(hashes) + texts
        self.text = np.zeros(size + 2, dtype=np.int64)  # 0 is the stop
        self.text[np.arange(len(hashes)) + self.row_of_words(first)] = ids + 1
        t = self.text
        key = t[:-2] << 2 * BITS | t[1:-1] << BITS | t[2:]
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]
        new = np.r_[True, self.key[1:] != self.key[:-1]] if size else np.zeros(0, bool)
        rank = np.zeros(size, dtype=np.int64)
        rank[self.order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        span = 3
        while span < depth:
            tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
            if not len(tied):
                break
            at = self.order[tied]
            pair = rank[at] * size + np.where(at + span < size, rank[np.minimum(at + span, size - 1)], 0)
            by = np.argsort(pair, kind="stable")
            pair = pair[by]
            self.order[tied] = at[by]
            new[tied] = fresh = np.r_[True, pair[1:] != pair[:-1]]
            rank[self.order[tied]] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
            span *= 2

    @staticmethod
    def row_of_words(first: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(first) - 1), np.diff(first))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The shard's numbers of the words, -1 for words that it has not."""
        if not len(self.names):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
        return np.where(self.names[at] == hashes, at + 1, -1)

    def _bound(self, words, at, width, lo, hi, upper: bool) -> np.ndarray:
        """Binary search in [lo, hi) for the words ``words[at:at + width]``, for all queries at once."""
        lo, hi = lo.copy(), hi.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            place = self.order[mid]
            side = np.zeros(len(live), dtype=np.int8)  # of the suffix against the query
            open_ = np.arange(len(live))
            step = 0
            while len(open_):
                open_ = open_[width[live[open_]] > step]
                a = self.text[np.minimum(place[open_] + step, len(self.text) - 1)]
                b = words[at[live[open_]] + step]
                side[open_] = np.sign(a - b)
                open_ = open_[a == b]
                step += 1
            after = side <= 0 if upper else side < 0
            lo[live[after]] = mid[after] + 1
            hi[live[~after]] = mid[~after]
            live = live[lo[live] < hi[live]]
        return lo

    def find(self, words: np.ndarray, at: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of ``order`` whose suffixes start with ``words[at:at + width]``; words are numbers of this shard."""
        lo, hi = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        lacking = np.append(0, np.cumsum(words < 0))
        can = np.flatnonzero(lacking[at + width] == lacking[at])
        if not len(can) or not len(self.key):
            return lo, hi
        a, w = at[can], width[can]
        low, span = np.zeros(len(can), np.int64), np.ones(len(can), np.int64)
        for k in range(3):
            has = w > k
            low = low << BITS | np.where(has, words[np.where(has, a + k, 0)], 0)
            span = np.where(has, 1, span << BITS)
        lo[can] = np.searchsorted(self.key, low)
        hi[can] = np.searchsorted(self.key, low + span)
        deep = can[(w > 3) & (lo[can] < hi[can])]
        if len(deep):
            start, end = lo[deep], hi[deep]
            lo[deep] = self._bound(words, at[deep], width[deep], start, end, False)
            hi[deep] = self._bound(words, at[deep], width[deep], lo[deep], end, True)
        return lo, hi

    def longest(self, words, at, left, lo, hi) -> np.ndarray:
        """Words of the longest match of ``words[at:at + left]`` among the suffixes in [lo, hi)."""
        point = self._bound(words, at, left, lo, hi, False)
        best = np.zeros(len(at), np.int64)
        for near in (point - 1, point):
            ok = np.flatnonzero((near >= lo) & (near < hi))
            step = 0
            while len(ok):
                ok = ok[left[ok] > step]
                ok = ok[self.text[np.minimum(self.order[near[ok]] + step, len(self.text) - 1)] == words[at[ok] + step]]
                step += 1
                best[ok] = np.maximum(best[ok], step)
        return best


def _segments(words: Words, reach: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first word, end word, bounds of texts) of stretches with at most ``SHARD_WORDS`` words, overlapping by ``reach`` less one."""
    n = len(words.starts)
    base, size = 0, max(SHARD_WORDS, 2 * reach)
    while True:
        end = min(n, base + size)
        yield base, end, np.clip(words.first, base, end) - base
        if end == n:
            return
        base = end - reach + 1


def _places(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, place) for every place of some ranges."""
    many = hi - lo
    which = np.repeat(np.arange(len(lo)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + lo[which]


def _hits(block: Block, words: Words, rows: int) -> tuple[list[list[dict] | None], list[list[str] | None]]:
    """Of each row, the stretches of words inside windows of the block, and the items that have these windows."""
    change = np.zeros(len(words.starts) + 1, np.int32)
    found: list[np.ndarray] = []
    hashes = words.hashes(lower=True)
    for base, end, first in _segments(words, int(block.width.max(initial=1))):
        shard = SuffixArray(hashes[base:end], first, int(block.width.max(initial=1)))
        one = block.one
        lo, hi = shard.find(shard.numbers(block.words), block.at[one], block.width[one])
        there = np.flatnonzero(lo < hi)
        if len(there):
            which, at = _places(lo[there], hi[there])
            place = shard.order[at]
            row = shard.row[place]
            word = place - row + base
            np.add.at(change, word, 1)
            np.add.at(change, word + block.width[one[there[which]]], -1)
            found.append(np.unique(row * len(one) + there[which]))
    hits: list[list[dict] | None] = [None] * rows
    items: list[list[str] | None] = [None] * rows
    if found:
        inside = np.r_[False, np.cumsum(change[:-1]) > 0, False]
        # a stretch ends with its text
        edge = np.zeros(len(inside), dtype=bool)
        edge[words.first + 1] = True
        here, before = inside[1:-1], inside[:-2]
        starts = np.flatnonzero(here & (~before | edge[1:-1]))
        ends = np.flatnonzero(here & (~inside[2:] | edge[2:])) + 1
        row = np.searchsorted(words.first, starts, "right") - 1
        for r, s, e in zip(row.tolist(), (starts - words.first[row]).tolist(), (ends - words.first[row]).tolist()):
            hits[r] = hits[r] or []
            hits[r].append({"lo": s, "n": e - s})
        pair = np.unique(np.concatenate(found))
        row, window = np.divmod(pair, len(block.one))
        bounds = np.append(np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), len(row))
        for s, e in zip(bounds[:-1], bounds[1:]):
            mark = np.zeros(len(block.items), dtype=bool)
            for w in window[s:e]:
                mark[block.owner[block.owners[w] : block.owners[w + 1]]] = True
            items[row[s]] = block.items[mark].tolist()
    return hits, items


def _search(shared, names: list[str], hits_only: bool):
    def run(batches):
        block = shared.value
        for batch in batches:
            for i, j, words in word_chunks(batch["_text"], SHARD_BYTES, GAP):
                hits, items = _hits(block, words, j - i)
                part = pa.RecordBatch.from_arrays(
                    [*(batch[c].slice(i, j - i) for c in names), pa.array(words.counts.astype(np.int64)),
                     pa.array(hits, pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())]))), pa.array(items, pa.list_(pa.string()))],
                    names=[*names, "n_words", "hits", "items"],
                )
                yield part.filter(part["hits"].is_valid()) if hits_only else part

    return run


def _pieces(window: int):
    """Items as hashes of their words, cut into pieces."""

    def run(batches):
        for batch in batches:
            ids = batch["item"].to_pylist()
            for i, j, words in word_chunks(batch["_text"], gap=GAP):
                hashes = words.hashes(lower=True)
                rows = []
                for x in range(i, j):
                    lo, hi = int(words.first[x - i]), int(words.first[x - i + 1])
                    step = max(1, PIECE_WORDS - window + 1)
                    for at in range(lo, max(lo + 1, hi - window + 1), step):
                        if lo < hi:
                            rows.append((ids[x], at - lo, hashes[at : min(hi, at + step + window - 1)].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))], names=["item", "at", "words"]
                    )

    return run


def benchmark_blocks(bench: DataFrame, window: int = WINDOW) -> Iterator[Block]:
    """Blocks of at most ``BLOCK_WORDS`` words, besides one piece; the driver holds one block and one partition of items."""
    source = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("_text"))
    pieces = stored(source.filter("_text is not null").mapInArrow(_pieces(window), "item string, at long, words binary"), "pieces")
    held: list[tuple[str, int, np.ndarray]] = []
    size, none = 0, True
    for row in pieces.toLocalIterator():
        held.append((row["item"], row["at"], np.frombuffer(bytes(row["words"]), U64)))
        size += len(held[-1][2])
        if size >= BLOCK_WORDS:
            yield Block(*map(list, zip(*held)), window)
            held, size, none = [], 0, False
    if held or none:
        yield Block(*(map(list, zip(*held)) if held else ([], [], [])), window)


def _union(hits):
    """Words in the union of stretches that may overlap."""
    def step(acc, x):
        end = x["lo"] + x["n"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["total"] + F.greatest(end - F.greatest(acc["end"], x["lo"]), F.lit(0))).cast("long").alias("total"),
        )

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    return F.coalesce(F.aggregate(F.array_sort(hits), start, step, lambda acc: acc["total"]), F.lit(0).cast("long"))


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any more) with n_words, n_hit, hits (stretches of hit words) and items (item_ids, as strings).

    Letters A-Z are lower-cased; words are runs of digits, letters and
    characters beyond ASCII. A window is ``window`` consecutive words of an
    item of ``bench`` (item_id, text), or all words of a shorter one. A word is
    hit if it lies inside an occurrence of a window. Null or empty texts have
    no words and are never hit; items without words have no window; items that
    share an item_id are one item, a null item_id counts as "". Long texts are
    searched whole, repeated rows one by one. ``carry`` names the columns to
    return (default: all); those named like a result are replaced. The rows of
    ``docs`` are not shuffled unless the benchmark needs more than one block.
    """
    text_batches(docs)
    out = ("n_words", "n_hit", "hits", "items")
    names = [c for c in (docs.columns if carry is None else carry) if c not in out]
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    keys = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text")]
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    own = "".join(f"`{c}` {types[c]}, " for c in names)
    result, more = None, []
    for block in benchmark_blocks(bench, window):
        shared = spark.sparkContext.broadcast(block)
        if result is None:
            first = docs.select(*names, *keys).mapInArrow(
                _search(shared, [*names, "_id", "_hash"], False),
                f"{own}_id string, _hash long, n_words long, hits {HITS}, items array<string>",
            )
            result = first
        else:
            found = docs.select(*keys).mapInArrow(
                _search(shared, ["_id", "_hash"], True), f"_id string, _hash long, n_words long, hits {HITS}, items array<string>"
            )
            more.append(stored(found, "hits"))
    if more:
        rest = more[0]
        for part in more[1:]:
            rest = rest.unionByName(part)
        rest = rest.groupBy("_id", "_hash").agg(
            F.flatten(F.collect_list("hits")).alias("_hits"), F.flatten(F.collect_list("items")).alias("_items")
        )
        none_h, none_i = F.array().cast(HITS), F.array().cast("array<string>")
        result = result.join(rest, ["_id", "_hash"], "left").withColumns({
            "hits": F.concat(F.coalesce("hits", none_h), F.coalesce("_hits", none_h)),
            "items": F.array_distinct(F.concat(F.coalesce("items", none_i), F.coalesce("_items", none_i))),
        })
    hits = F.coalesce("hits", F.array().cast(HITS))
    return result.select(
        *names, "n_words", _union(hits).alias("n_hit"), hits.alias("hits"),
        F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
    )


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without a word that is hit; see ``contamination``."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")  # own columns may be named like a result
    return contamination(rows, bench, window, ["_row"]).filter("n_hit = 0").select("_row.*")


def _longest(shared):
    def run(batches):
        block = shared.value
        for batch in batches:
            doc = batch["doc_id"].to_numpy(zero_copy_only=False)
            for i, j, words in word_chunks(batch["_text"], SHARD_BYTES, GAP):
                hashes = words.hashes(lower=True)
                for base, end, first in _segments(words, block.depth):
                    shard = SuffixArray(hashes[base:end], first, block.depth)
                    number = shard.numbers(block.words)
                    lo, hi = shard.find(number, block.at, block.width)
                    q = np.flatnonzero(lo < hi)
                    if not len(q):
                        continue
                    size = shard.longest(number, block.at[q], block.left[q], lo[q], hi[q])
                    lo, hi = shard.find(number, block.at[q], size)
                    which, at = _places(lo, hi)
                    place = shard.order[at]
                    row = shard.row[place]
                    word = place - row + base - words.first[row]
                    by = np.lexsort((word, doc[i:j][row], which))
                    best = by[np.flatnonzero(np.r_[True, which[by][1:] != which[by][:-1]])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block.items[block.item[q]], pa.string()), pa.array(block.place[q]), pa.array(size),
                         pa.array(doc[i:j][row[best]]), pa.array(word[best])],
                        names=["item_id", "item_word", "n", "doc_id", "doc_word"],
                    )

    return run


def longest_matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id string, item_word, n, doc_id, doc_word): of every benchmark suffix its longest verbatim match and where it lies.

    Suffixes without a match of ``window`` words (or of the whole, shorter,
    item) have no row; of equally long matches the smallest doc_id and place is
    told. doc_id must be an integer; rows without one are left out. Matches of
    an item of over ``PIECE_WORDS`` words end with the piece.
    """
    text_batches(docs)
    own = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    found = None
    for block in benchmark_blocks(bench, window):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        part = own.mapInArrow(_longest(shared), "item_id string, item_word long, n long, doc_id long, doc_word long")
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct((-F.col("n")).alias("m"), "doc_id", "doc_word")).alias("b")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", (-F.col("b.m")).alias("n"), "b.doc_id", "b.doc_word"
    )
