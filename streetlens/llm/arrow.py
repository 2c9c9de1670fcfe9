"""Groups of rows within the sorted partitions of an Arrow stream."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str], rows: int = 1) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, starts): runs of whole groups of at least ``rows`` rows, if there are as many.

    The stream must be sorted by ``keys`` (integers without nulls); starts has
    the first row of each group and the number of rows at its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        starts = _starts(table, keys)
        last = starts[-2]
        if last and last >= rows:
            yield table.slice(0, last), starts[:-1]
            held = table.slice(last).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, _starts(table, keys)


def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    change[0] = True
    for key in keys:
        values = table[key].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)
