"""Mixing sources to target weights with exact block quotas.

The documents of a source form a stream of words in hashed order, cut into
blocks of equal size. A source's target fixes its quota of blocks. A splitting
tree over the output shards divides the quotas: at every node the left half
draws its share of all blocks from the sources by a multivariate hypergeometric
draw, so every quota is met exactly. Each source's blocks are put in order by a
permutation (a new one for each pass over the source); consecutive stretches of
it go to the shards, so no block is drawn twice in a pass. Within a shard, rows
are ordered by a hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetlens.llm.tables import stored, text_batches
from streetlens.llm.words import U64, mix

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
ROWS = 500  # documents of a bucket, about
FINE = 2048  # blocks of a source, at least; its words come within half a block of the target
LARGEST = 4096  # words of a block, unless the corpus would then have over 2**28 blocks
PIECE = "array<struct<shard:int,place:long,pass:int,lo:long,n:long>>"


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    block: int
    quota: int  # blocks to draw, all passes together
    seed: int

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)


def fill_targets(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Share ``total`` by weight; nobody above ``cap`` times its size, the excess shared again by weight."""
    target = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        left = total - sum(target[k] for k in range(len(sizes)) if k not in set(free))
        weight = sum(weights[k] for k in free)
        over = [k for k in free if left * weights[k] / weight > cap * sizes[k]]
        for k in over or free:
            target[k] = float(cap * sizes[k]) if over else left * weights[k] / weight
        if not over:
            break
        free = [k for k in free if k not in set(over)]
    return target


def plan_sources(found: list[tuple[str | None, int]], weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 0) -> list[Source]:
    """Targets, blocks and quotas of the sources, in code point order with null last."""
    found = sorted(found, key=lambda s: (s[0] is None, s[0] or ""))
    total = sum(size for _, size in found)
    targets = fill_targets([s for _, s in found], [weights[k % len(weights)] for k in range(len(found))], share * total, cap)
    out = []
    for k, ((name, size), target) in enumerate(zip(found, targets)):
        block = max(1, min(size // FINE, max(LARGEST, total >> 28)))
        passes = int(target // size) if size else 0
        rest = min(-(-size // block), round((target - passes * size) / block)) if size else 0
        out.append(Source(name, size, target, block, passes * -(-size // block) + rest, seed * 1_000_003 + k))
    return out


def split_quotas(quotas: list[int], shards: int, seed: int = 0) -> np.ndarray:
    """Blocks of each source (row) for each shard (column): rows add up to the quotas, columns are even."""
    out = np.zeros((len(quotas), shards), np.int64)
    even = np.diff(np.arange(shards + 1) * sum(quotas) // shards)
    nodes = [(0, shards, np.array(quotas, np.int64))]
    while nodes:
        lo, hi, have = nodes.pop()
        if hi - lo == 1:
            out[:, lo] = have
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(have, int(even[lo:mid].sum()), method="marginals") if len(have) else have
        nodes += [(lo, mid, left), (mid, hi, have - left)]
    return out


def permuted(index: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Where a permutation of ``range(size)`` sends each index: a Feistel network, walked until it lands inside."""
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2, 1).astype(U64)
    low = (U64(1) << half) - U64(1)
    out = index.astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        x, h, m, s = out[todo], half[todo], low[todo], seed[todo].astype(U64)
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + s * U64(0x9E3779B97F4A7C15) + U64(turn + 1)) & m)
        x = (left << h) | right
        out[todo] = x
        todo = todo[x >= size[todo].astype(U64)]
    return out.astype(np.int64)


def draw(sources: list[Source], cuts: np.ndarray, source: np.ndarray, start: np.ndarray, size: np.ndarray):
    """(row, shard, place, pass, offset in the row, words) of everything drawn from the rows; cuts has the shards' ends by source."""
    block = np.array([s.block for s in sources])[source]
    first = start // block
    many = np.where(size > 0, (start + size - 1) // block - first + 1, 0)
    row = np.repeat(np.arange(len(size)), many)
    number = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
    lo = np.maximum(number * block[row], start[row])
    hi = np.minimum((number + 1) * block[row], (start + size)[row])
    blocks = np.array([s.blocks for s in sources])[source][row]
    quota = np.array([s.quota for s in sources])[source][row]
    seed = np.array([s.seed for s in sources])[source][row]
    found = []
    for turn in range(int(max([-(-s.quota // s.blocks) for s in sources if s.blocks], default=0))):
        live = np.flatnonzero(turn * blocks < quota)
        place = permuted(number[live], blocks[live], seed[live] * 64 + turn) + turn * blocks[live]
        live, place = live[place < quota[live]], place[place < quota[live]]
        shard = np.zeros(len(live), np.int64)
        for s in np.unique(source[row[live]]):
            own = source[row[live]] == s
            shard[own] = np.searchsorted(cuts[s], place[own], "right")
        r = row[live]
        found.append((r, shard, mix(place.astype(U64) + seed[live].astype(U64) * U64(0xD1B54A32D192ED03)).view(np.int64), np.full(len(live), turn), lo[live] - start[r], (hi - lo)[live]))
    if not found:
        return (np.zeros(0, np.int64),) * 6
    parts = [np.concatenate(x) for x in zip(*found)]
    order = np.lexsort((parts[4], parts[3], parts[0]))
    return tuple(p[order] for p in parts)


def _draws(sources: list[Source], cuts: np.ndarray, names: list[str], schema: pa.DataType):
    def run(batches):
        for batch in batches:
            source, start, size = (batch[c].to_numpy() for c in ("_source", "_start", "size"))
            row, shard, place, turn, lo, n = draw(sources, cuts, source, start, size)
            pieces = pa.StructArray.from_arrays(
                [pa.array(shard.astype(np.int32)), pa.array(place), pa.array(turn.astype(np.int32)), pa.array(lo), pa.array(n)],
                fields=list(schema.value_type),
            )
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pieces, type=schema)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), lists], names=[*names, "pieces"])

    return run


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, shards: int = 64, seed: int = 0) -> DataFrame:
    """``docs`` (doc_id, source, text or size, any more) with size, source_size, target and pieces.

    size is the number of words of text (null: 0), unless ``docs`` has a column
    size. pieces lists what the mix takes of the row: shard, place in the
    shard's order, pass over the source, first word and number of words. Rows
    equal in doc_id and size are interchangeable. A null source is a source of
    its own, last in order. The driver holds one row per source and shard.
    Columns of ``docs`` named like a result are replaced. Runs jobs.
    """
    spark = docs.sparkSession
    text_batches(docs)
    docs = docs.drop("source_size", "target", "pieces", "_source", "_start", "_bucket", "_order")
    if "size" not in docs.columns:
        docs = docs.withColumn("size", word_count(F.col("text")))
    buckets = max(16, docs.count() // ROWS)
    docs = docs.withColumn("_order", F.xxhash64("doc_id", "size")).withColumn("_bucket", F.pmod(F.col("_order"), F.lit(buckets)).cast("int"))
    filled = stored(docs.groupBy("source", "_bucket").agg(F.sum("size").alias("words")), "filled")
    sources = plan_sources([(r["source"], r["words"]) for r in filled.groupBy("source").agg(F.sum("words").alias("words")).collect()], weights, share, cap, seed)
    cuts = np.cumsum(split_quotas([s.quota for s in sources], shards, seed), axis=1)
    known = spark.createDataFrame(
        [(s.name, k, s.size, s.target) for k, s in enumerate(sources)], "_name string, _source int, source_size long, target double"
    )
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = filled.withColumn("_base", F.coalesce(F.sum("words").over(before), F.lit(0))).join(
        known, F.col("source").eqNullSafe(F.col("_name"))
    ).select("_name", F.col("_bucket").alias("_b"), "_source", "_base", "source_size", "target")
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        bases, (F.col("_bucket") == F.col("_b")) & F.col("source").eqNullSafe(F.col("_name"))
    ).withColumn("_start", F.col("_base") + F.col("_inside"))
    names = [c for c in docs.columns if c not in ("_bucket", "_order")] + ["source_size", "target"]
    placed = placed.select(*names, "_source", "_start")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*names).schema)
    arrow = pa.list_(pa.struct([("shard", pa.int32()), ("place", pa.int64()), ("pass", pa.int32()), ("lo", pa.int64()), ("n", pa.int64())]))
    return placed.mapInArrow(_draws(sources, cuts, names, arrow), f"{schema}, pieces {PIECE}")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the columns of ``docs`` once per pass that takes words of a row, with the text taken.

    A row taken whole in a pass keeps its text as it is; otherwise the text is
    its taken words in order, joined by one space, and n_chars (if there is
    one) is counted anew.
    """
    columns = docs.columns
    passes = F.array_distinct(F.transform("pieces", lambda p: p["pass"]))
    mixed = mix_sources(docs, **options).withColumn("_pass", F.explode(passes))
    own = F.filter("pieces", lambda p: p["pass"] == F.col("_pass"))
    taken = F.aggregate(own, F.lit(0).cast("long"), lambda total, p: total + p["n"])
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    partly = F.array_join(F.flatten(F.transform(own, lambda p: F.slice(words, (p["lo"] + 1).cast("int"), p["n"].cast("int")))), " ")
    mixed = mixed.withColumn("text", F.when(taken == F.col("size"), F.col("text")).otherwise(partly))
    if "n_chars" in columns:
        mixed = mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*columns)
