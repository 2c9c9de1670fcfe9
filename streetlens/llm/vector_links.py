"""Links between embeddings of high cosine, with randomised-rotation binary codes.

A unit vector is rotated at random and stored as the signs of its coordinates
together with a correction factor, the inner product of the vector with its own
sign vector. The inner product of the sign vector with another rotated vector,
divided by that factor, is an unbiased estimate of the cosine, and its error has
a known bound. A pair whose estimate plus bound stays below the threshold is
done; every other pair is computed exactly, in double precision.

Pairs to look at come from tables of signs under further rotations: two vectors
meet if all signs of one table agree. The number of signs grows with the
logarithm of the number of vectors, the number of tables follows from the wanted
recall for a pair right at the threshold. Buckets are compared in blocks of
bounded size; a pair is counted in the first table in which it meets. Only
counts and a spanning forest leave a block. Equal vectors stand as one, with
their number.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.arrow import sorted_groups
from streetlens.llm.jaccard_join import Forest
from streetlens.llm.tables import stored
from streetlens.operators.components import connected_components
from streetlens.session import cut

BLOCK = 200
BUCKET = 8  # vectors of a bucket, about, before near copies
SURE = 4.0  # width of the confidence bound in units of the error's scale


def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def table_plan(vectors: int, cosine: float, recall: float) -> tuple[int, int]:
    """(signs of a table, tables) so that a pair right at the threshold meets with probability ``recall``."""
    signs = min(62, max(4, round(math.log2(max(vectors, 1) / BUCKET + 1))))
    agree = (1 - math.acos(cosine) / math.pi) ** signs
    return signs, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def binary_code(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, correction factor, rotated vectors) of unit vectors."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, 0)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(dim), turned


def estimates(packed: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated cosines of coded with rotated vectors, error bound of each coded vector)."""
    dim = turned.shape[1]
    signs = (2.0 * np.unpackbits(packed, axis=1, count=dim).astype(np.float32) - 1) / math.sqrt(dim)
    bound = SURE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
    return (signs @ turned.T.astype(np.float32)) / factor[:, None], bound


def _prepared(kind: np.dtype):
    """Valid vectors as bytes, with a digest; null where a vector links with nothing."""

    def run(batches):
        for batch in batches:
            column = batch["embedding"]
            sizes, flat = column.value_lengths().fill_null(0).to_numpy(), column.flatten()
            values = np.asarray(flat.to_numpy(zero_copy_only=False), dtype=kind)  # null components turn to NaN
            packed, digest = [None] * batch.num_rows, [None] * batch.num_rows
            ends = np.cumsum(sizes)
            for k, (a, b) in enumerate(zip(ends - sizes, ends)):
                v = values[a:b]
                if b > a and np.isfinite(v).all() and np.linalg.norm(v.astype(np.float64)) > 0:
                    packed[k] = v.tobytes()
                    digest[k] = hashlib.blake2b(packed[k], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(digest, pa.binary()), pa.array(packed, pa.binary())], names=["vec_id", "digest", "packed"]
            )

    return run


def _by_length(packed: list[bytes]) -> list[np.ndarray]:
    lengths = np.array([len(p) for p in packed])
    return [np.flatnonzero(lengths == n) for n in np.unique(lengths)]


def _unit(packed: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    norm = np.linalg.norm(raw, axis=1)
    return raw, raw / norm[:, None]


def _entries(signs: int, tables: int, kind: np.dtype):
    """One row per vector and table: (table, key) of the bucket, with the code, the factor and the keys of all tables."""

    def run(batches):
        for batch in batches:
            vec, many, packed = batch["vec_id"].to_numpy(), batch["many"].to_numpy(), batch["packed"].to_pylist()
            for rows in _by_length(packed):
                own = [packed[r] for r in rows]
                _, unit = _unit(own, kind)
                dim = unit.shape[1]
                code, factor, _ = binary_code(unit)
                need = signs * tables
                bits = np.concatenate([unit @ rotation(dim, 1 + k) > 0 for k in range(-(-need // dim))], axis=1)[:, :need]
                keys = (bits.reshape(len(own), tables, signs) << np.arange(signs, dtype=np.int64)).sum(axis=2)
                keys = keys + (np.int64(dim % 2) << 62)  # vectors of other lengths are told apart in the block
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), t, np.int32)), pa.array(np.ascontiguousarray(keys[:, t])), pa.array(vec[rows]), pa.array(many[rows]),
                         pa.array(own, pa.binary()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor),
                         pa.array([k[:t].tobytes() for k in keys], pa.binary())],
                        names=["t", "key", "vec_id", "many", "packed", "code", "factor", "before"],
                    )

    return run


def _blocks(entries: DataFrame) -> DataFrame:
    """Buckets of more than ``BLOCK`` vectors as pairs of blocks."""
    wide = entries.groupBy("t", "key").agg(F.count("*").alias("c")).filter(F.col("c") > BLOCK).select(
        "t", "key", F.ceil(F.col("c") / F.lit(BLOCK)).cast("int").alias("blocks")
    )
    return (
        entries.join(wide, ["t", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("blocks", "other")
    )


def block_links(packed, code, factor, before, block, apart, cosine, kind) -> np.ndarray:
    """Pairs (rows of two indices) within a block whose cosine reaches the threshold and that met in no table before."""
    found = []
    for rows in _by_length(packed):
        raw, unit = _unit([packed[r] for r in rows], kind)
        turned = unit @ rotation(unit.shape[1], 0)
        near, bound = estimates(code[rows], factor[rows], turned)
        may = np.triu(near + bound[:, None] >= cosine, 1)
        if apart:
            may &= block[rows][:, None] != block[rows][None, :]
        a, b = np.nonzero(may)
        if not len(a):
            continue
        new = ~(before[rows][a] == before[rows][b]).any(axis=1)
        a, b = a[new], b[new]
        norm = np.sqrt((raw * raw).sum(axis=1))
        exact = (raw[a] * raw[b]).sum(axis=1) / (norm[a] * norm[b])
        hit = exact >= cosine
        found.append(np.stack([rows[a[hit]], rows[b[hit]]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _linked(cosine: float, kind: np.dtype):
    """Kind 0: (vector, links counted in this block). Kind 1: the links of a spanning forest of the block."""

    def run(batches):
        for table, starts in sorted_groups(batches, ["t", "key", "i", "j"]):
            vec, many, block, t = (table[c].to_numpy() for c in ("vec_id", "many", "block", "t"))
            i, j, factor = (table[c].to_numpy() for c in ("i", "j", "factor"))
            packed, code, before = (table[c].to_pylist() for c in ("packed", "code", "before"))
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a < 2:
                    continue
                width = max(len(c) for c in code[a:b])
                codes = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in code[a:b]), np.uint8).reshape(b - a, width)
                met = np.frombuffer(b"".join(before[a:b]), np.int64).reshape(b - a, t[a])
                pairs = block_links(packed[a:b], codes, factor[a:b], met, block[a:b], i[a] != j[a], cosine, kind)
                if not len(pairs):
                    continue
                count = np.bincount(pairs[:, 0], many[a:b][pairs[:, 1]], b - a) + np.bincount(pairs[:, 1], many[a:b][pairs[:, 0]], b - a)
                some = np.flatnonzero(count)
                forest, tree = Forest(b - a), []
                for x, y in pairs.tolist():
                    if forest.root(x) != forest.root(y):
                        forest.join(x, y)
                        tree.append((x, y))
                x, y = np.array(tree).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([0, 1], np.int32), [len(some), len(x)])), pa.array(np.append(vec[a:b][some], vec[a:b][x])),
                     pa.array(np.append(count[some].astype(np.int64), vec[a:b][y]))],
                    names=["kind", "x", "y"],
                )

    return run


def link_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.99) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Links pairs with a cosine of at least ``cosine``, never one below it; a pair
    right at the threshold is found with probability ``recall``, closer ones
    almost surely, equal vectors always. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without vec_id, link with
    nothing. Vectors of different lengths do not link. Rows that share a vec_id
    are each returned, and count as vectors of their own. Runs several jobs.
    """
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kind = np.dtype("f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "f8")
    base = stored(vectors.mapInArrow(_prepared(kind), "vec_id long, digest binary, packed binary"), "vectors")
    valid = base.filter("digest is not null and vec_id is not null")
    heads = cut(valid.groupBy("digest").agg(F.min("vec_id").alias("head"), F.count("*").alias("many")).withColumn("node", F.xxhash64("digest")))
    signs, tables = table_plan(heads.count(), cosine, recall)
    # rows may repeat with their vec_id: one of them stands for its digest
    distinct = valid.join(heads, "digest").filter("vec_id = head").groupBy("node", "many").agg(F.max("packed").alias("packed"))
    entries = distinct.select(F.col("node").alias("vec_id"), "many", "packed").mapInArrow(
        _entries(signs, tables, kind),
        "t int, key long, vec_id long, many long, packed binary, code binary, factor double, before binary",
    )
    met = cut(
        _blocks(entries).repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
        .mapInArrow(_linked(cosine, kind), "kind int, x long, y long")
    )
    counts = met.filter("kind = 0").groupBy(F.col("x").alias("node")).agg(F.sum("y").alias("links"))
    names = heads.select("node", "head")
    edges = (
        met.filter("kind = 1")
        .join(names.select(F.col("node").alias("x"), F.col("head").alias("a")), "x")
        .join(names.select(F.col("node").alias("y"), F.col("head").alias("b")), "y").select("a", "b")
        .unionByName(valid.join(heads, "digest").filter("vec_id <> head").select(F.col("vec_id").alias("a"), F.col("head").alias("b")))
    )
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    parts = connected_components(nodes, edges).select(F.col("node").alias("vec_id"), "component")
    rows = base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest"))
    return (
        rows.join(heads, "digest", "left").join(counts, "node", "left").join(parts, "vec_id", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("many") - 1, F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
