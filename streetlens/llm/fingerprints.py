"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every word shingle is hashed once; the top bits of the hash name a bin, and a
bin keeps its smallest hash. An empty bin takes the value of another one, found
by walking from a hashed start in hashed odd steps over all bins until one is
filled (optimal densification). Of each value the low-order bits are stored; the
share of equal bins is corrected for those that agree by chance.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_LOG = 7
BINS = 1 << BINS_LOG
BITS = 8
WIDTH = 5
BUCKETS = 512  # of neighbouring doc_ids; one more array element to compare per row for each
QUICK = 4  # steps of the walk that are looked at one by one

_dice = random.Random(20)
_START = [_dice.randrange(BINS) for _ in range(BINS)]
_STEP = [_dice.randrange(BINS // 2) * 2 + 1 for _ in range(BINS)]  # odd, so the walk meets every bin


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _bin(value: Column) -> Column:
    return F.shiftright(value, 64 - BINS_LOG).cast("int") + BINS // 2  # rises with the (signed) value


def _shingle_hashes(words: Column) -> Column:
    """Hashes of the shingles; fewer words than a shingle has are one; no word, none."""
    many = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WIDTH)))
    )
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) < WIDTH, F.array(F.xxhash64(w))).otherwise(many(w)),
    )


def _least(values: Column) -> Column:
    """The smallest value of each bin, rising."""
    return let(
        F.sort_array(values),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))),
    )


def _spread(least: Column) -> Column:
    """One entry per bin, null where it is empty."""
    nulls = lambda n: F.array_repeat(F.lit(None).cast("bigint"), n)
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(least, i - 1)))
    filled = F.flatten(F.transform(least, lambda x, i: F.concat(nulls(_bin(x) - before(i) - 1), F.array(x))))
    return F.concat(filled, nulls(BINS - 1 - _bin(F.get(least, F.size(least) - 1))))


def _densified(bins: Column) -> Column:
    start, step = F.lit(_START), F.lit(_STEP)
    quick = [F.lit([(s + k * d) % BINS for s, d in zip(_START, _STEP)]) for k in range(QUICK)]
    walk = lambda b: F.filter(
        F.transform(F.sequence(F.lit(QUICK), F.lit(BINS - 1)), lambda k: F.get(bins, F.pmod(F.get(start, b) + k * F.get(step, b), F.lit(BINS)))),
        lambda x: x.isNotNull(),
    )
    return F.transform(bins, lambda x, b: F.coalesce(x, *(F.get(bins, F.get(q, b)) for q in quick), F.get(walk(b), F.lit(0))))


def minhash(text: Column) -> Column:
    """The low-order bits of every bin (array of int); empty for a text without words or null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    low = lambda bins: F.transform(_densified(bins), lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))
    return let(
        _least(_shingle_hashes(words)),
        lambda m: F.when(F.size(m) == 0, F.array().cast("array<int>")).otherwise(let(_spread(m), low)),
    )


def packed(bins: Column) -> Column:
    """A fingerprint as lowercase hex, ``BITS`` bits per bin; an empty one is an empty string."""
    return F.lower(F.array_join(F.transform(bins, lambda x: F.lpad(F.hex(x), BITS // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two empty fingerprints are alike, an empty and a filled one are not."""
    chance = 2.0**-BITS
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    share = (equal / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.greatest(share, F.lit(0.0)))
    )


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with fingerprint_bins (array of int) and fingerprint (hex); equal texts have equal ones."""
    return docs.withColumn("fingerprint_bins", minhash(F.col(text))).withColumn("fingerprint", packed(F.col("fingerprint_bins")))


def with_next(docs: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with next_<column>: the values of the row that follows in descending doc_id; after the last comes the first.

    Rows with one doc_id follow each other by the hash of their text; a null
    doc_id comes last. Rows are dealt into buckets of neighbouring ids by cut
    points (approximate quantiles); the first row of each bucket is also sent
    to the end of the bucket before it, so no row meets more than its bucket.
    The driver holds one row per bucket. Runs two jobs.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_tie", F.xxhash64("text"))
    marks = docs.select(F.percentile_approx("_id", [k / buckets for k in range(1, buckets)], 100 * buckets)).first()[0]
    cuts = F.lit(sorted(set(marks or [0])))
    docs = docs.withColumn("_bucket", F.when(F.col("_id").isNull(), -1).otherwise(F.size(F.filter(cuts, lambda c: c < F.col("_id")))))
    heads = docs.groupBy("_bucket").agg(F.max(F.struct("_id", "_tie")).alias("h")).orderBy("_bucket").collect()
    sent = spark.createDataFrame(
        [(r["h"]["_id"], r["h"]["_tie"], heads[(k + 1) % len(heads)]["_bucket"]) for k, r in enumerate(heads)], "_hid long, _htie long, _to int"
    )
    routed = docs.join(F.broadcast(sent), F.col("_id").eqNullSafe(F.col("_hid")) & F.col("_tie").eqNullSafe(F.col("_htie")), "left")
    own = F.struct(F.col("_bucket").alias("at"), F.lit(0).alias("copy"))
    also = F.struct(F.col("_to").alias("at"), F.lit(1).alias("copy"))
    routed = routed.withColumn("_place", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, also))))
    following = Window.partitionBy("_place.at").orderBy("_place.copy", F.col("_id").desc_nulls_last(), F.col("_tie").desc())
    out = routed.select("*", *(F.lead(c).over(following).alias(f"next_{c}") for c in columns)).filter("_place.copy = 0")
    return out.drop("_id", "_tie", "_bucket", "_hid", "_htie", "_to", "_place")
