"""Repeated passages across documents, with prefix-partitioned suffix trees.

Every window of ``depth`` words is a suffix cut at that depth. Its place in the
partition is given by an anchor, the least-hashed ``GRAM``-word sequence inside
it, so equal windows always meet; all windows of a document that share an
anchor travel as one context (one row), not as one row per suffix.

Suffixes below one anchor form a group. Contexts that equal each other word by
word are settled by the smallest document alone. Where contexts differ, a group
of up to ``GROUP`` contexts fits in memory and becomes a subtree: suffixes are
ordered by prefix doubling and the leaves below one internal node of depth
``depth`` are equal windows; runs of them are the maximal repeats. A larger
group is split further by longer prefixes, which are as long as the window
itself: such a group is a single deep node and needs only its smallest
document, which a partial aggregation finds before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.arrow import sorted_groups
from streetlens.llm.tables import stored, text_batches
from streetlens.llm.words import U64, WORDS, Powers, find_words, mix, range_hash, word_chunks, text_buffers

GRAM = 10
GROUP = 200
SEGMENT = (1 << 24) - 1
ROWS = 512  # contexts per subtree build, at least
OTHER = Powers(0xBF58476D1CE4E5B9 | 3)

SPAN = "doc_id long, uid long, lo int, n int"


def _anchor_runs(hashes: np.ndarray, row: np.ndarray, depth: int):
    """(anchor position, first window, number of windows) of every run of windows with one anchor."""
    width = depth - GRAM + 1
    out = []
    for base in range(0, max(1, len(hashes) - depth + 1), SEGMENT - depth):
        part = hashes[base : base + SEGMENT]
        n = len(part) - depth + 1
        if n < 1:
            break
        at = np.arange(len(part) - GRAM + 1)
        # 40 bits of hash before 24 bits of position: the leftmost of equals wins
        least = (range_hash(part, WORDS, at, at + GRAM) & ~U64(SEGMENT)) | at.astype(U64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:n], least[width - span : width - span + n])
        here = row[base : base + len(part)]
        window = np.flatnonzero(here[:n] == here[depth - 1 : depth - 1 + n])
        if len(window):
            anchor = (least[window] & U64(SEGMENT)).astype(np.int64)
            new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1) | (here[window[1:]] != here[window[:-1]])])
            out.append((anchor[new] + base, window[new] + base, np.diff(np.append(new, len(window)))))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchors(depth: int):
    def run(batches):
        for batch in batches:
            doc, uid = batch["doc_id"].to_numpy(), batch["uid"].to_numpy()
            for i, j, words in word_chunks(batch["text"]):
                hashes, row = words.hashes(), words.row
                anchor, lo, n = _anchor_runs(hashes, row, depth)
                if not len(lo):
                    continue
                a = range_hash(hashes, WORDS, anchor, anchor + GRAM)
                c = mix(range_hash(hashes, OTHER, lo, lo + n + depth - 1) + (anchor - lo).astype(U64))
                r = row[lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc[i:j][r]), pa.array(uid[i:j][r]),
                     pa.array((lo - words.first[r]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["a", "c", "doc_id", "uid", "lo", "n"],
                )

    return run


def _contexts(depth: int):
    """Kind 0: a context as text for its subtree. Kind 1: each window of a group that is split further, by its whole prefix."""
    names = ["kind", "k1", "k2", "doc_id", "uid", "lo", "n", "words"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches):
        for batch in batches:
            doc, uid = batch["doc_id"].to_numpy(), batch["uid"].to_numpy()
            wanted = batch["wanted"]
            for i, j, words in word_chunks(batch["text"]):
                hashes = None
                out = [[] for _ in names]
                for x in range(i, j):
                    first = int(words.first[x - i])
                    for w in wanted[x].as_py():
                        lo, n = first + w["lo"], w["n"]
                        if w["wide"]:
                            hashes = words.hashes() if hashes is None else hashes
                            at = np.arange(lo, lo + n)
                            one, two = (range_hash(hashes, p, at, at + depth).view(np.int64).tolist() for p in (WORDS, OTHER))
                            rows = [(1, p, q, int(doc[x]), int(uid[x]), w["lo"] + k, 1, None) for k, (p, q) in enumerate(zip(one, two))]
                        else:
                            text = words.data[words.starts[lo] : words.ends[lo + n + depth - 2]].tobytes()
                            rows = [(0, w["a"], 0, int(doc[x]), int(uid[x]), w["lo"], n, text)]
                        for row in rows:
                            for column, value in zip(out, row):
                                column.append(value)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return run


def deep_nodes(ids: np.ndarray, leaves: np.ndarray, depth: int) -> np.ndarray:
    """For each leaf (start of a suffix), the node at ``depth`` above it: equal numbers mean equal first ``depth`` symbols.

    Suffixes are ranked by their first 1, 2, 4, … symbols; the rank for a
    prefix comes from the ranks of its two halves, which may overlap.
    """
    rank, span = ids.astype(np.int64), 1
    while span < depth:
        step = min(span, depth - span)
        pair = rank[:-step] * (len(ids) + 1) + rank[step:] if step < len(rank) else rank[:0]
        rank = np.unique(pair, return_inverse=True)[1]
        span += step
    return rank[leaves]


def _subtrees(depth: int):
    def run(batches):
        for table, _ in sorted_groups(batches, ["k1"], ROWS):
            doc, uid, lo, n = (table[c].to_numpy() for c in ("doc_id", "uid", "lo", "n"))
            data, off = text_buffers(pa.chunked_array([c.cast(pa.string()) for c in table["words"].chunks]))
            words = find_words(data[off[0] : off[-1]], off - off[0])
            ids = np.unique(words.hashes(), return_inverse=True)[1]
            row = np.repeat(np.arange(len(n)), n)
            within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            node = deep_nodes(ids, words.first[row] + within, depth)
            order = np.argsort(node, kind="stable")
            at = np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]])
            least = np.empty(len(row), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(doc[row][order], at), np.diff(np.append(at, len(row))))
            hit = np.flatnonzero(doc[row] > least)
            if len(hit):
                new = np.flatnonzero(np.r_[True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])])
                h = hit[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[row[h]]), pa.array(uid[row[h]]), pa.array((lo[row[h]] + within[h]).astype(np.int32)),
                     pa.array(np.diff(np.append(new, len(hit))).astype(np.int32))],
                    names=["doc_id", "uid", "lo", "n"],
                )

    return run


def repeated_windows(docs: DataFrame, depth: int = 50) -> DataFrame:
    """(doc_id, uid, lo, n): n windows from word lo on whose words also start in a document with a smaller doc_id.

    ``docs`` has doc_id (long), uid (long, telling rows of one doc_id apart) and text.
    """
    docs = docs.filter("doc_id is not null and text is not null")
    runs = docs.select("doc_id", "uid", "text").mapInArrow(_anchors(depth), "a long, c long, " + SPAN)
    # totals are stored before they are joined back: a join of plain exchanges lets Spark split a hot key
    met = stored(
        runs.groupBy("a").agg(
            F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min("c").alias("c0"), F.max("c").alias("c1")
        ).filter("d0 < d1"),
        "met",
    )
    shared = stored(
        runs.join(met, "a").select("a", "c", "doc_id", "uid", "lo", "n", "d0", (F.col("c0") == F.col("c1")).alias("alike")), "shared"
    )
    span = ["doc_id", "uid", "lo", "n"]
    alike = shared.filter("alike and doc_id > d0").select(span)
    mixed = shared.filter("not alike").drop("alike", "d0")
    owned = mixed.join(stored(mixed.groupBy("a", "c").agg(F.min("doc_id").alias("owner")), "owners"), ["a", "c"])
    copied = owned.filter("doc_id > owner").select(span)
    own = owned.filter("doc_id = owner").drop("owner")
    wide = stored(own.groupBy("a").agg(F.count("*").alias("k")).filter(F.col("k") > GROUP).select("a", F.lit(True).alias("wide")), "wide")
    wanted = own.join(wide, "a", "left").groupBy("doc_id", "uid").agg(
        F.collect_list(F.struct("a", "lo", "n", F.coalesce("wide", F.lit(False)).alias("wide"))).alias("wanted")
    )
    contexts = stored(
        docs.join(wanted, ["doc_id", "uid"]).select("doc_id", "uid", "text", "wanted").mapInArrow(
            _contexts(depth), f"kind int, k1 long, k2 long, {SPAN}, words binary"
        ),
        "contexts",
    )
    grown = contexts.filter("kind = 0").repartition("k1").sortWithinPartitions("k1").mapInArrow(_subtrees(depth), SPAN)
    long = contexts.filter("kind = 1")
    nodes = stored(long.groupBy("k1", "k2").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).filter("d0 < d1"), "nodes")
    split = long.join(nodes, ["k1", "k2"]).filter("doc_id > d0").select(span)
    return alike.unionByName(copied).unionByName(grown).unionByName(split)


def _kept(depth: int, names: list[str]):
    def run(batches):
        for batch in batches:
            spans = batch["_spans"]
            sizes = np.zeros(batch.num_rows, np.int64)
            gone = np.zeros(batch.num_rows, np.int64)
            kept = [None] * batch.num_rows
            lists = [s.as_py() for s in spans]
            for i, j, words in word_chunks(batch["text"]):
                sizes[i:j] = words.counts
                for x in range(i, j):
                    keep = None
                    if lists[x]:
                        change = np.zeros(sizes[x] + 1, np.int32)
                        lo = np.array([s["lo"] for s in lists[x]])
                        np.add.at(change, lo, 1)
                        np.add.at(change, lo + np.array([s["n"] for s in lists[x]]) + depth - 1, -1)
                        keep = np.cumsum(change[:-1]) == 0
                        gone[x] = sizes[x] - int(keep.sum())
                    kept[x] = words.joined(x - i, keep)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(sizes), pa.array(gone), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*names, "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, depth: int = 50) -> DataFrame:
    """``docs`` (doc_id, text, any more) with n_words, n_removed and kept: the words that stay, joined by one space.

    A word goes if a window of ``depth`` consecutive words covers it whose
    sequence also starts in a document with a smaller doc_id. Texts that are
    null, empty or shorter than a window lose nothing (kept is then all words,
    possibly none). A row without doc_id is never compared. Rows with the same
    doc_id are compared with other documents only. Columns of ``docs`` named
    like a result are replaced. Runs several jobs.
    """
    out = ("n_words", "n_removed", "kept")
    text_batches(docs)
    docs = docs.drop(*out, "_uid", "_spans").withColumn("_uid", F.xxhash64("text"))
    found = repeated_windows(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_uid").alias("uid"), F.col("text").cast("string").alias("text")), depth
    )
    spans = found.groupBy("doc_id", "uid").agg(F.collect_list(F.struct("lo", "n")).alias("_spans")).select(
        F.col("doc_id").alias("_doc"), F.col("uid").alias("_uid"), "_spans"
    )
    names = [c for c in docs.columns if c != "_uid"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_uid")
    joined = docs.join(spans, (docs["doc_id"] == spans["_doc"]) & (docs["_uid"] == spans["_uid"]), "left").select(*names, "_spans")
    return joined.mapInArrow(_kept(depth, names), f"{schema}, n_words long, n_removed long, kept string")
