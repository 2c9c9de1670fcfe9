"""Places of rows in the order of their group, without one task for a large group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetlens.llm.tables import stored


def group_key(column: str) -> Column:
    """A text key without nulls that tells the values of ``column``, null among them, apart."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def changes(keys: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Whether each entry but the first differs from the one before it."""
    if isinstance(keys, pa.ChunkedArray):
        keys = keys.combine_chunks()
    return pc.not_equal(keys.slice(1), keys.slice(0, max(0, len(keys) - 1))).to_numpy(zero_copy_only=False)


def _local_places(group: str):
    def run(batches):
        last, place = None, -1
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.r_[batch[group][0].as_py() != last, changes(batch[group])]
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            places = np.where(start < 0, at + place + 1, at - start)
            last, place = batch[group][n - 1].as_py(), int(places[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], names=[*batch.schema.names, "_at"])

    return run


def placed(rows: DataFrame, group: str, order: Sequence[Column | str], out: str, name: str) -> DataFrame:
    """``rows``, stored, with ``out``: the 0-based place (long) of each row in the order of its group.

    Rows are dealt into ranges of group and order, so a large group lies in
    many partitions. A group that goes on from one range to the next is the
    first one there, so the offsets have at most one row per partition; they
    are broadcast. Rows that are equal in all of ``order`` stand as they come.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("_tie")]
    dealt = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    local = stored(dealt.mapInArrow(_local_places(group), f"{schema}, _at long"), name)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_off", F.sum("_n").over(before)).filter("_off is not null").select(group, "_part", "_off")
    return local.join(F.broadcast(offsets), [group, "_part"], "left").withColumn(
        out, F.col("_at") + F.coalesce("_off", F.lit(0))
    ).drop("_part", "_at", "_off")
