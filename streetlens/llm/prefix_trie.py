"""The trie of conversation prefixes, from whole sequences.

Identical conversations collapse into one weighted sequence with the list of
its ends. Every sequence is then laid out as its prefixes, one row per depth,
named by a hash of all turns up to there. Sequences whose name is also that of
a proper prefix drop out by anti-join; the others are the leaves. Sums over
weighted prefixes give the nodes.

A node is owned by the sequence of its smallest member. Along a sequence the
nodes it owns are the deepest ones, from some depth on, so what a subtree sums
over its nodes is a sum over the sequences through its top: of each, the part
from there on, or from where it owns nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from streetlens.llm.ordered import changes, placed
from streetlens.llm.tables import stored, text_batches
from streetlens.llm.words import U64, Powers

_BASES = (Powers(0x9E3779B97F4A7C15 | 3), Powers(0xC2B2AE3D27D4EB4F | 3))


def rebuilt_turns(turns: DataFrame, modulus: int = 9, step: int = 5) -> DataFrame:
    """Placed turns (conv_id, pos, …) of conversations that start with turns of another one.

    Conversation c takes the first h turns of c - c % ``step`` and then its own
    behind its first h, where h is the CRC-32 of c as decimal text modulo
    ``modulus``. Returns conv_id, depth (from 1) and the columns beside pos.
    """
    more = [c for c in turns.columns if c not in ("conv_id", "pos")]
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_own")).withColumn(
        "_h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    ).withColumn("_from", F.col("conv_id") - F.col("conv_id") % step)
    ids = stored(ids, "ids")
    sizes = ids.select(F.col("conv_id").alias("_from"), F.col("_own").alias("_there"))
    known = stored(ids.join(sizes, "_from", "left").withColumn("_taken", F.least("_h", F.coalesce("_there", F.lit(0)))), "taken")
    # at most modulus - 1 turns of a conversation are lent, to at most step others
    lent = turns.filter((F.col("conv_id") % step == 0) & (F.col("pos") < modulus - 1)).withColumnRenamed("conv_id", "_from")
    heads = known.filter("_taken > 0").select("conv_id", "_from", "_taken").join(lent, "_from").filter("pos < _taken")
    own = turns.join(known.select("conv_id", "_h", "_taken"), "conv_id").filter("pos >= _h")
    return heads.select("conv_id", (F.col("pos") + 1).alias("depth"), *more).unionByName(
        own.select("conv_id", (F.col("pos") - F.col("_h") + F.col("_taken") + 1).alias("depth"), *more)
    )


def _running(batches):
    """Sums of each turn's numbers times powers of its depth, and of its bytes, from where its conversation starts in the partition."""
    last, sums = None, [U64(0), U64(0), np.int64(0)]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, depth = batch["conv_id"].to_numpy(), batch["depth"].to_numpy()
        new = np.r_[last is None or conv[0] != last, conv[1:] != conv[:-1]]
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        out = []
        for k, name in enumerate(("k1", "k2", "bytes")):
            value = batch[name].to_numpy()
            if k < 2:
                value = value.view(U64) * _powers(_BASES[k], depth)
            total = np.concatenate([np.zeros(1, value.dtype), np.cumsum(value)])
            here = total[1:] - total[start]
            here[: int(np.argmax(new)) if new.any() else n] += sums[k]
            out.append(here)
            sums[k] = here[-1]
        last = conv[-1]
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], batch["depth"], batch["bytes"], *(pa.array(x.view(np.int64)) for x in out), batch["_part"]],
            names=["conv_id", "depth", "bytes", "s1", "s2", "upto", "_part"],
        )


def _powers(base: Powers, depth: np.ndarray) -> np.ndarray:
    """base ** depth modulo 2**64, by squaring, so that depths may be large."""
    out, square, left = np.ones(len(depth), U64), U64(base.base), depth.astype(U64)
    with np.errstate(over="ignore"):
        while left.any():
            out = np.where(left & U64(1), out * square, out)
            square, left = square * square, left >> U64(1)
    return out


def _wrapped(column: str, window: WindowSpec) -> Column:
    """Sum of 64-bit numbers modulo 2**64."""
    whole = F.lit(str(1 << 64)).cast("decimal(20,0)")
    part = F.pmod(F.sum(F.col(column).cast("decimal(38,0)")).over(window), whole)
    return F.when(part >= F.lit(str(1 << 63)).cast("decimal(20,0)"), part - whole).otherwise(part).cast("long")


def _add_offsets(batches):
    for batch in batches:
        columns = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("s1", "s2", "upto", "o1", "o2", "oup")}
        sums = [(columns[a].view(U64) + columns[b].view(U64)).view(np.int64) for a, b in (("s1", "o1"), ("s2", "o2"), ("upto", "oup"))]
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], batch["depth"], batch["bytes"], *map(pa.array, sums)], names=["conv_id", "depth", "bytes", "p1", "p2", "upto"]
        )


def prefix_names(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, bytes, p1, p2, upto): for every prefix two 64-bit hashes of all its turns, and its bytes.

    ``turns`` has conv_id, depth (from 1 on, without gaps), k1, k2 (hashes of a
    turn) and bytes. Runs in ranges of conversations and depths; a conversation
    that goes on in the next range gets the sums of the ranges before.
    """
    dealt = turns.select("conv_id", "depth", "k1", "k2", "bytes").repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    local = stored(
        dealt.withColumn("_part", F.spark_partition_id()).mapInArrow(
            _running, "conv_id long, depth long, bytes long, s1 long, s2 long, upto long, _part int"
        ),
        "running",
    )
    # the last sums of each range; only the first conversation of a range has one before it
    ends = local.groupBy("conv_id", "_part").agg(F.max(F.struct("depth", "s1", "s2", "upto")).alias("e")).select("conv_id", "_part", "e.*")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        "conv_id", "_part", _wrapped("s1", before).alias("o1"), _wrapped("s2", before).alias("o2"), F.sum("upto").over(before).alias("oup")
    ).filter("oup is not null")
    joined = local.join(F.broadcast(offsets), ["conv_id", "_part"], "left").fillna(0, ["o1", "o2", "oup"])
    return joined.select("conv_id", "depth", "bytes", "s1", "s2", "upto", "o1", "o2", "oup").mapInArrow(
        _add_offsets, "conv_id long, depth long, bytes long, p1 long, p2 long, upto long"
    )


def _ends(batches):
    """Of each sequence the number and smallest of its ends, and the digest of all, as a stream."""
    key, found = None, None

    def row():
        return (*key, *found[:2], found[2].hexdigest())

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        names = [batch[c] for c in ("depth", "p1", "p2")]
        new = np.r_[key is None or tuple(c[0].as_py() for c in names) != key, np.any([changes(c) for c in names], axis=0) if n > 1 else np.zeros(0, bool)]
        starts = np.append(np.flatnonzero(new), n)
        ids = batch["conv_id"].to_pylist()
        done = []
        if not new[0]:
            found[2].update(("," + ",".join(map(str, ids[: starts[0]]))).encode())
            found[0] += int(starts[0])
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if key is not None:
                done.append(row())
            key = tuple(c[s].as_py() for c in names)
            found = [e - s, ids[s], hashlib.sha256(",".join(map(str, ids[s:e])).encode())]
        if done:
            yield _ends_batch(done)
    if key is not None:
        yield _ends_batch([row()])


def _ends_batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 5 + [pa.string()])], names=["depth", "p1", "p2", "weight", "conv_id", "ends"]
    )


def whole_sequences(prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """(depth, p1, p2, weight, conv_id, ends): identical conversations as one, with its smallest member and the digest of all."""
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2")).alias("e"))
    zero = F.lit(0).cast("long")
    named = ids.join(last, "conv_id", "left").select(
        *(F.coalesce(F.col(f"e.{c}"), zero).alias(c) for c in ("depth", "p1", "p2")), "conv_id"
    )
    # ordered by name and id; a digest is sequential, so each sequence's ids pass one task in batches
    return named.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "conv_id").mapInArrow(
        _ends, "depth long, p1 long, p2 long, weight long, conv_id long, ends string"
    )


def prefix_trie(prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, the textless root among them.

    ``prefixes`` comes from ``prefix_names``; ``ids`` has every conv_id, those
    without turns too. Returns conv_id (the smallest member), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, bytes of a node's last text times the
    members beyond the first) and ends_sha256. Without conversations there is
    no node. Runs several jobs.
    """
    sequences = stored(whole_sequences(prefixes, ids), "sequences")
    name = ["depth", "p1", "p2"]
    of = sequences.select("conv_id", F.col("depth").alias("size"), "weight")
    total = prefixes.groupBy("conv_id").agg(F.sum("bytes").alias("total"))
    zero = F.lit(0).cast("long")
    kept = stored(of.join(total, "conv_id", "left").withColumn("total", F.coalesce("total", zero)), "kept")
    rows = prefixes.join(kept, "conv_id")
    roots = kept.select("conv_id", zero.alias("depth"), zero.alias("bytes"), zero.alias("p1"), zero.alias("p2"), zero.alias("upto"), "size", "weight", "total")
    laid = stored(rows.select(*roots.columns).unionByName(roots), "laid")
    proper = laid.filter("depth < size").select(*name).distinct()
    leaves = sequences.join(proper, name, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    # the smallest member of the nodes that several sequences share; sequences own all others
    shared = stored(laid.groupBy(*name).agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "shared")
    of_root, deeper = shared.filter("depth = 0"), shared.filter("depth > 0")
    # the root, which all share, has one row; deeper shared nodes are joined by plain exchanges, so a hot one can be split
    met = laid.filter("depth > 0").join(deeper, name).select("conv_id", "depth", "least").unionByName(
        laid.filter("depth = 0").join(F.broadcast(of_root), name).select("conv_id", "depth", "least")
    )
    met = stored(met, "met")
    owned = met.filter("least <> conv_id").groupBy("conv_id").agg((F.max("depth") + 1).alias("owns"))
    facts = stored(kept.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left").select(
        "conv_id", F.coalesce("owns", zero).alias("owns"), F.coalesce("leaf", zero).alias("leaf")
    ), "facts")
    known = laid.join(facts, "conv_id")
    # bytes behind the prefix, its own last text included
    behind = F.col("total") - F.col("upto") + F.col("bytes")
    # the bytes of the prefix at which the sequence starts to own nodes
    start = stored(known.filter("depth = owns - 1 and owns > 0").select("conv_id", F.col("upto").alias("before")), "start")
    known = known.join(start, "conv_id", "left")
    own_behind = F.when(F.col("depth") >= F.col("owns"), behind).otherwise(F.col("total") - F.coalesce("before", zero))
    nodes = known.groupBy(*name).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.count_if((F.col("depth") < F.col("size")) & (F.col("depth") + 1 >= F.col("owns"))).alias("n_children"),
        F.sum(F.col("weight") * behind - own_behind).alias("saved_tokens"),
    )
    # a parent's smallest member: the node above on the owner's way, if it is shared, else the owner itself
    above = met.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("least").alias("up"))
    digests = sequences.select(*name, "ends")
    return nodes.join(above, ["conv_id", "depth"], "left").join(digests, name, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations (conv_id, turn, role, text, any more); see ``rebuilt_turns`` and ``prefix_trie``.

    Turns stand by turn (nulls first), then by the hash of role and text; null
    roles and texts are empty, repeated rows are turns of their own. Rows
    without a conv_id belong to no conversation. An empty table has no node,
    not even a root. Turns are compared by 128 bits of hash, prefixes by 128
    more. Texts are hashed where they are read and never shuffled.
    """
    text_batches(conversations)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    half = lambda start: F.conv(F.substring("digest", start, 15), 16, 10).cast("long")
    placed_turns = placed(turns, "conv_id", [F.col("turn").asc_nulls_first(), "digest"], "pos", "turns").select(
        "conv_id", "pos", "bytes", F.xxhash64("digest").alias("k1"), half(1).alias("k2"),
    )
    placed_turns = stored(placed_turns, "placed")
    prefixes = stored(prefix_names(rebuilt_turns(placed_turns)), "prefixes")
    return prefix_trie(prefixes, placed_turns.select("conv_id").distinct())
