"""Near-duplicate documents by Jaccard similarity of word shingles, with parity sketches.

Shingles of a document are dealt by hash into the m pieces of a sketch; a piece
is the XOR of its shingles' hashes. Sets that differ in d shingles differ in at
most d pieces, so a pair within the allowed difference D has at least m - D
equal pieces. m is fixed per size band. Pieces are put in one order for all
documents of a band, those with most rare shingles first, and each document
sends only its first D + 1 pieces: two sets with m - D equal pieces must meet in
one of these (pigeonhole). Which shingles count as frequent only moves pieces
made of passages that very many documents share to the end of the order; the
result is the same for any choice. Documents that meet are verified on their
whole sets.

Rows with equal sets are one class from the start. All members of a piece's
group are compared with each other inside the cell of the group's smallest
member, in blocks of bounded size: first by parity sketches of about one bit
per shingle, whose Hamming distance is never above the true difference, and
what passes, on the whole sets. Out of a cell come smaller cells and then a
spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.arrow import sorted_groups
from streetlens.llm.tables import stored
from streetlens.llm.words import U64, distinct, mix, shingles, word_chunks
from streetlens.operators.components import connected_components
from streetlens.session import cut

FLUSH = 1 << 19  # entries held by a task before they are sent
PARTS = 256  # destinations of pieces, at least
HOT = 64  # members of a piece in one flush beyond which the flush sends them apart
SKETCH_BLOCK, SET_BLOCK = 1000, 600  # documents of a block; two blocks are compared at once
OFTEN = 4  # documents of one flush from which a shingle counts as frequent
FREQUENT = 100_000  # frequent shingles told to all tasks, at most: the most frequent ones
LEAST_BITS = 256


class Measure:
    """Sizes, differences and bands that belong to a similarity of ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def partner(self, n):
        """Largest set that can be similar to one of n."""
        return n * self.den // self.num

    def differ(self, total):
        """Most shingles by which two similar sets with ``total`` members together can differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def similar(self, a: int, b: int, common: int) -> bool:
        return self.den * common >= self.num * (a + b - common)

    def pieces(self, band):
        """Number of pieces of a band's sketch; the spare quarter lets documents pass over empty pieces."""
        top = (np.int64(2) << band) - 1
        return np.maximum((self.differ(top + self.partner(top)) + 1) * 5 // 4, np.minimum(4 * top, 64))


def _sketch_keys(measure, values, rare, counts, chosen, band, allowed):
    """(key, row) of the first ``allowed + 1`` pieces of the chosen rows' sketches."""
    row_of = np.repeat(np.arange(len(counts)), counts)
    take = chosen[row_of]
    row, v, rare = row_of[take], values[take], rare[take]
    if not len(row):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    m = measure.pieces(band)
    spread = mix(v ^ U64(0xA24BAED4963EE407))
    piece = ((spread >> U64(32)) * m[row].astype(U64)) >> U64(32)
    place = (row.astype(U64) << U64(40)) | piece
    order = np.argsort(place)
    place, v, rare = place[order], v[order], rare[order]
    at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    parity = np.bitwise_xor.reduceat(mix(v), at)
    size = np.diff(np.append(at, len(v)))
    unusual = np.add.reduceat(rare.astype(np.int64), at)
    row, piece = (place[at] >> U64(40)).astype(np.int64), place[at] & U64((1 << 40) - 1)
    name = _piece_name(band[row], piece)
    key = mix(parity ^ name + size.astype(U64))
    # the same order for all, as equal pieces have equal shingles; ties by the key itself
    order = np.lexsort((key, -size, -unusual, row))
    row, key = row[order], key[order]
    filled = np.bincount(row, minlength=len(counts))
    rank = np.arange(len(row)) - (np.cumsum(filled) - filled)[row]
    keep = rank <= allowed[row]
    keys, rows = [key[keep]], [row[keep]]
    for r in np.flatnonzero(chosen & (filled <= allowed)):  # small sets with too few filled pieces
        used = piece[order][row == r]
        free = np.setdiff1d(np.arange(m[r]).astype(U64), used)
        empty = np.sort(mix(_piece_name(np.full(len(free), band[r]), free)))[: allowed[r] + 1 - filled[r]]
        keys.append(empty)
        rows.append(np.full(len(empty), r))
    return np.concatenate(keys), np.concatenate(rows)


def _piece_name(band, piece):
    return mix(piece * U64(0x9FB21C651E98DF25) + (band.astype(U64) << U64(48)))


def piece_keys(measure: Measure, values: np.ndarray, row: np.ndarray, n_rows: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) for every row's own band and, where a smaller set of the band below can be similar, for that band.

    ``frequent`` has shingles in rising order.
    """
    at = np.minimum(np.searchsorted(frequent, values), max(len(frequent) - 1, 0))
    rare = frequent[at] != values if len(frequent) else np.ones(len(values), bool)
    counts = np.bincount(row, minlength=n_rows)
    some = counts > 0
    band = np.zeros(n_rows, np.int64)
    band[some] = np.floor(np.log2(counts[some])).astype(np.int64)
    own = _sketch_keys(measure, values, rare, counts, some, band, measure.differ(counts + measure.partner(counts)))
    floor = (np.int64(1) << band) - 1  # the largest set of the band below
    down = some & (band > 0) & (counts <= measure.partner(floor))
    below = _sketch_keys(measure, values, rare, counts, down, np.maximum(band - 1, 0), measure.differ(floor + counts))
    return np.concatenate([own[0], below[0]]), np.concatenate([own[1], below[1]])


def _sets(column, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, words in word_chunks(column):
        values, row = distinct(*shingles(words, words.hashes(lower=True), width))
        yield i, j, values, row


def parity_sketches(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """One bit sketch per row: every shingle flips the bit that its hash names. There are at least as many bits as shingles."""
    out = []
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends):
        bits = max(LEAST_BITS, 1 << int(b - a).bit_length())
        at = (mix(values[a:b]) & U64(bits - 1)).astype(np.int64)
        out.append(np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1).tobytes() if b > a else b"")
    return out


def _often(values: list[np.ndarray]) -> pa.RecordBatch:
    """Shingles of at least ``OFTEN`` of the documents, as rows of kind 1."""
    all_values = np.sort(np.concatenate(values))
    at = np.flatnonzero(np.r_[True, all_values[1:] != all_values[:-1]])
    many = np.diff(np.append(at, len(all_values)))
    found = all_values[at[many >= OFTEN]].view(np.int64)
    none = pa.nulls(len(found), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(found), np.int32)), none, pa.array(many[many >= OFTEN]), pa.array(found), none, pa.nulls(len(found), pa.binary())],
        names=["kind", "doc_id", "n_shingles", "sig_a", "sig_b", "sketch"],
    )


def _signatures(width: int):
    """Kind 0: size, signature and sketch of each row's set. Kind 1: frequent shingles, with their number in n_shingles."""

    def run(batches):
        seen, held = [], 0
        for batch in batches:
            sizes, first, second, sketches = [], [], [], []
            for i, j, values, row in _sets(batch["text"], width):
                n = np.bincount(row, minlength=j - i)
                full = np.flatnonzero(n)
                at = (np.cumsum(n) - n)[full]
                for out, salt in ((first, 0x8CB92BA72F3D8DD7), (second, 0xE7037ED1A0B428DB)):
                    sig = np.zeros(j - i, U64)
                    if len(full):
                        sig[full] = np.add.reduceat(mix(values ^ U64(salt)), at)
                    out.append(sig.view(np.int64))
                sizes.append(n)
                sketches += parity_sketches(values, n)
                seen.append(values)
                held += len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(batch.num_rows, np.int32)), batch["doc_id"],
                 *(pa.array(np.concatenate(x).astype(np.int64)) for x in (sizes, first, second)), pa.array(sketches, pa.binary())],
                names=["kind", "doc_id", "n_shingles", "sig_a", "sig_b", "sketch"],
            )
            if held >= FLUSH:
                yield _often(seen)
                seen, held = [], 0
        if held:
            yield _often(seen)

    return run


def _entries(measure: Measure, width: int, parts: int, frequent: np.ndarray):
    """Pieces packed by destination: kind 0 has (key, document) pairs, kind 1 the members of one key that is hot here."""

    def flush(keys, ids):
        key, doc = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.append(at, len(key)))
        kinds, parts_of, blobs_k, blobs_d = [], [], [], []
        cold = np.repeat(size <= HOT, size)
        for a, n in zip(at[size > HOT], size[size > HOT]):
            for x in range(a, a + n, 4096):
                kinds.append(1)
                parts_of.append(int(mix(key[x : x + 1] + U64(x))[0] % U64(parts)))
                blobs_k.append(key[x : x + 1].tobytes())
                blobs_d.append(doc[x : min(x + 4096, a + n)].tobytes())
            cold[a] = True  # the smallest member stands for them
        hot = ~np.repeat(size <= HOT, size)[cold]
        key, doc = key[cold], doc[cold]
        part = (key % U64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, key, doc, hot = part[order], key[order], doc[order], hot[order]
        at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(at, [*at[1:], len(part)]):
            for kind, own in ((0, ~hot[a:b]), (2, hot[a:b])):
                if own.any():
                    kinds.append(kind)
                    parts_of.append(int(part[a]))
                    blobs_k.append(key[a:b][own].tobytes())
                    blobs_d.append(doc[a:b][own].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(parts_of, pa.int32()), pa.array(blobs_k, pa.binary()), pa.array(blobs_d, pa.binary())],
            names=["kind", "part", "keys", "docs"],
        )

    def run(batches):
        keys, ids, held = [], [], 0
        for batch in batches:
            doc = batch["doc_id"].to_numpy(zero_copy_only=False)
            for i, j, values, row in _sets(batch["text"], width):
                key, r = piece_keys(measure, values, row, j - i, frequent)
                keys.append(key)
                ids.append(doc[i:j][r])
                held += len(key)
                if held >= FLUSH:
                    yield flush(keys, ids)
                    keys, ids, held = [], [], 0
        if held:
            yield flush(keys, ids)

    return run


def _meet(batches):
    """Kind 0: (hub, member) of each piece's group. Kind 1: (key, member), kind 2: (key, hub) of keys that were hot in a task."""
    for table, starts in sorted_groups(batches, ["part"]):
        kinds = table["kind"].to_numpy()
        all_keys, all_docs = table["keys"], table["docs"]
        for a, b in zip(starts[:-1], starts[1:]):  # one destination at a time bounds the memory
            yield from _meet_at(kinds[a:b], all_keys.slice(a, b - a).to_pylist(), all_docs.slice(a, b - a).to_pylist())


def _meet_at(kind: np.ndarray, keys: list[bytes], docs: list[bytes]) -> Iterator[pa.RecordBatch]:
    out = []
    for k, d in ((keys[x], docs[x]) for x in np.flatnonzero(kind == 1)):
        member = np.frombuffer(d, np.int64)
        out.append((1, np.full(len(member), np.frombuffer(k, np.int64)[0]), member))
    plain = np.flatnonzero(kind != 1)
    if len(plain):
        key = np.concatenate([np.frombuffer(keys[x], U64) for x in plain])
        doc = np.concatenate([np.frombuffer(docs[x], np.int64) for x in plain])
        hot = np.repeat(kind[plain] == 2, [len(keys[x]) // 8 for x in plain])
        order = np.lexsort((doc, key))
        key, doc, hot = key[order], doc[order], hot[order]
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.append(at, len(key)))
        hub = np.repeat(doc[at], size)
        pairs = np.unique(np.stack([hub, doc], 1)[np.repeat(size > 1, size) & (hub != doc)], axis=0)
        out.append((0, pairs[:, 0], pairs[:, 1]))
        if hot.any():
            told = np.logical_or.reduceat(hot, at)
            out.append((2, key[at][told].view(np.int64), doc[at][told]))
    for kind_of, x, y in out:
        if len(x):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), kind_of, np.int32)), pa.array(np.ascontiguousarray(x)), pa.array(np.ascontiguousarray(y))],
                names=["kind", "x", "y"],
            )


def _packed_sets(width: int):
    def run(batches):
        for batch in batches:
            packed = []
            for i, j, values, row in _sets(batch["text"], width):
                ends = np.cumsum(np.bincount(row, minlength=j - i))
                packed += [values[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return run


def _allowed(measure: Measure, n: np.ndarray, block: np.ndarray, apart: bool) -> np.ndarray:
    """Pairs (above the diagonal) whose sizes can be similar; only between the two blocks if ``apart``."""
    may = np.triu(np.maximum(n[:, None], n[None, :]) <= measure.partner(np.minimum(n[:, None], n[None, :])), 1)
    return may & (block[:, None] != block[None, :]) if apart else may


def sketch_pairs(measure: Measure, n: np.ndarray, sketches: list[bytes], may: np.ndarray) -> np.ndarray:
    """The pairs of ``may`` whose sketches do not differ by more bits than similar sets can by shingles."""
    near = np.zeros_like(may)
    bits = np.array([8 * len(s) for s in sketches])
    for level in np.unique(bits):  # a wide sketch folds onto a narrower one
        wide = np.flatnonzero(bits >= level)
        signs = np.empty((len(wide), level), np.float32)
        for k, x in enumerate(wide):
            flips = np.unpackbits(np.frombuffer(sketches[x], np.uint8)).reshape(-1, level)
            signs[k] = 1.0 - 2.0 * np.bitwise_xor.reduce(flips, axis=0)
        own = bits[wide] == level
        hamming = (level - signs[own] @ signs.T) / 2
        rows = wide[own]
        ok = hamming <= measure.differ(n[rows][:, None] + n[wide][None, :])
        near[np.ix_(rows, wide)] |= ok
        near[np.ix_(wide, rows)] |= ok.T
    return may & near


class Forest:
    """Trees of linked members; the smallest index is the root."""

    def __init__(self, size: int):
        self.top = list(range(size))

    def root(self, x: int) -> int:
        while self.top[x] != x:
            self.top[x] = self.top[self.top[x]]
            x = self.top[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.top[max(x, y)] = min(x, y)


def cell_links(measure: Measure, docs: np.ndarray, sets: list[np.ndarray], block: np.ndarray, apart: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between the documents."""
    n = np.array([len(s) for s in sets])
    may = _allowed(measure, n, block, apart)
    if len(sets) > 8:
        may = sketch_pairs(measure, n, parity_sketches(np.concatenate(sets), n), may)
    forest, found = Forest(len(sets)), []
    for a, b in zip(*(x.tolist() for x in np.nonzero(may))):
        if forest.root(a) != forest.root(b):
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if measure.similar(int(n[a]), int(n[b]), common):
                forest.join(a, b)
                found.append((int(docs[a]), int(docs[b])))
    return found


def cell_parts(measure: Measure, docs: np.ndarray, n: np.ndarray, sketches: list[bytes], block: np.ndarray, apart: bool) -> list[tuple[int, int]]:
    """(smallest member, member) of the parts into which the sketches split a cell."""
    forest = Forest(len(docs))
    for a, b in zip(*(x.tolist() for x in np.nonzero(sketch_pairs(measure, n, sketches, _allowed(measure, n, block, apart))))):
        forest.join(a, b)
    parts: dict[int, list[int]] = {}
    for k in range(len(docs)):
        parts.setdefault(forest.root(k), []).append(int(docs[k]))
    return [(min(p), x) for p in parts.values() for x in p if x != min(p)]


def _cells(measure: Measure, screen: bool):
    def run(batches):
        for table, starts in sorted_groups(batches, ["hub", "i", "j"]):
            docs, block = table["member"].to_numpy(), table["block"].to_numpy()
            i, j = table["i"].to_numpy(), table["j"].to_numpy()
            payload = table["sketch" if screen else "packed"].to_pylist()
            n = table["n_shingles"].to_numpy() if screen else None
            found = []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a < 2:
                    continue
                apart = i[a] != j[a]
                if screen:
                    found += cell_parts(measure, docs[a:b], n[a:b], payload[a:b], block[a:b], apart)
                else:
                    found += cell_links(measure, docs[a:b], [np.frombuffer(p, U64) for p in payload[a:b]], block[a:b], apart)
            if found:
                x, y = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return run


def _compared(pairs: DataFrame, payload: DataFrame, measure: Measure, screen: bool) -> DataFrame:
    """(a, b): what comparing the members of every hub's cell gives."""
    cells = pairs.unionByName(pairs.select("hub", F.col("hub").alias("member")).distinct())
    return (
        _cell_blocks(cells, SKETCH_BLOCK if screen else SET_BLOCK).join(payload.withColumnRenamed("doc_id", "member"), "member")
        .repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
        .mapInArrow(_cells(measure, screen), "a long, b long")
    )


def _cell_blocks(cells: DataFrame, size: int) -> DataFrame:
    """Cells of more than ``size`` members as pairs of blocks."""
    wide = cells.groupBy("hub").agg(F.count("*").alias("c")).filter(F.col("c") > size).select(
        "hub", F.ceil(F.col("c") / F.lit(size)).cast("int").alias("blocks")
    )
    return (
        cells.join(wide, "hub", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", "member", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )


def jaccard_components(docs: DataFrame, num: int = 75, den: int = 100, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets of
    ``width``-word shingles (A-Z lower-cased; with fewer words the whole
    sequence is one shingle). component_id is the smallest doc_id reachable by
    links. A text that is null or has no word has an empty set and its own
    component; a null doc_id has a null component. Rows that share a doc_id are
    each returned and count as one node with the union of their links. Runs
    several jobs.
    """
    spark = docs.sparkSession
    measure = Measure(num, den)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(
        docs.mapInArrow(_signatures(width), "kind int, doc_id long, n_shingles long, sig_a long, sig_b long, sketch binary"), "light"
    )
    light = first.filter("kind = 0").drop("kind")
    often = first.filter("kind = 1").groupBy("sig_a").agg(F.sum("n_shingles").alias("many"))
    often = often.orderBy(F.desc("many"), "sig_a").limit(FREQUENT).select("sig_a").toArrow()["sig_a"].to_numpy()
    frequent = np.sort(often.view(U64) if len(often) else np.zeros(0, U64))
    named = light.filter("doc_id is not null and n_shingles > 0")
    heads = named.groupBy("sig_a", "sig_b", "n_shingles").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"))
    copies = cut(
        named.join(heads.filter("head <> last"), ["sig_a", "sig_b", "n_shingles"])
        .filter("doc_id <> head").select("doc_id", "head").distinct()
    )

    # destinations of pieces; a pair that meets in several of one destination leaves it once
    parts = max(PARTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = cut(
        docs.filter("doc_id is not null")
        .mapInArrow(_entries(measure, width, parts, frequent), "kind int, part int, keys binary, docs binary")
        .repartition("part").sortWithinPartitions("part")
        .mapInArrow(_meet, "kind int, x long, y long")
    )
    hot = met.filter("kind = 1").select(F.col("x").alias("key"), F.col("y").alias("member")).join(
        met.filter("kind = 2").select(F.col("x").alias("key"), F.col("y").alias("hub")), "key"
    ).select("hub", "member")
    pairs = met.filter("kind = 0").select(F.col("x").alias("hub"), F.col("y").alias("member")).unionByName(hot).distinct()
    for side in ("hub", "member"):  # copies stand back behind their head
        pairs = pairs.join(copies.select(F.col("doc_id").alias(side), F.col("head").alias("h")), side, "left").withColumn(
            side, F.coalesce("h", side)
        ).drop("h")
    pairs = cut(pairs.filter("hub <> member").distinct())
    sketches = named.select("doc_id", "n_shingles", "sketch")
    near = cut(_compared(pairs, sketches, measure, screen=True).select(F.col("a").alias("hub"), F.col("b").alias("member")).distinct())
    wanted = near.select(F.col("member").alias("doc_id")).unionByName(near.select(F.col("hub").alias("doc_id"))).distinct()
    sets = docs.join(wanted, "doc_id").mapInArrow(_packed_sets(width), "doc_id long, packed binary")
    links = cut(_compared(near, sets, measure, screen=False))
    edges = links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    touched = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    found = connected_components(touched, edges).select(F.col("node").alias("doc_id"), "component")
    return light.join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
