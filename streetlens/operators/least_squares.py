"""Least squares for very many small regressions at once.

Spark adds up the cross products per key; what is left is one short row per
regression, and the small systems are solved in batches of such rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cross_products(df: DataFrame, keys: Sequence[str], columns: Sequence[Column], target: Column, *extra: Column) -> DataFrame:
    """(keys, n, xx, xy, yy): sums of products of ``columns`` (lower triangle, by row) and ``target``."""
    prepared = df.withColumns({f"_x{i}": c for i, c in enumerate(columns)}).withColumn("_y", target)
    pairs = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(len(columns)) for j in range(i + 1)]
    return prepared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*pairs).alias("xx"),
        F.array(*[F.sum(F.col(f"_x{i}") * F.col("_y")) for i in range(len(columns))]).alias("xy"),
        F.sum(F.col("_y") * F.col("_y")).alias("yy"),
        *extra,
    )


def _whole_series(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole series of a stream in which every series starts at position 0."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(batch["_pos"].to_numpy() == 0)
        if len(starts):
            done = [*held, batch.slice(0, starts[-1])]
            if any(b.num_rows for b in done):
                yield pa.Table.from_batches(done)
            held = [batch.slice(starts[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def running_products(
    rows: DataFrame, keys: Sequence[str], position: str, sets: Mapping[str, tuple[Sequence[Column], Column]], ended: Column, *carry: Column,
    history: Column | None = None,
) -> DataFrame:
    """(keys, ended, carry, one column per set) for the rows at which a training window ends.

    ``rows`` has one row per key and 0-based position and is dealt by ``keys``.
    ``ended`` is an array of the windows that end with a row; rows where it is
    empty are only added up. A set is a list of columns and an array of
    positions; its result has, for each two neighbouring positions, the sums of
    products of the columns (lower triangle, by row; null counts as 0) over the
    rows between. Sums run once over each series, whatever the number of
    windows: a window's products are differences of running sums. A task holds
    the running sums of the series that it is at, one row per period. With
    ``history`` there is also a column of that name: the values of that column
    over the whole series at the last row of each series, null at all others.
    """
    columns = {f"_{name}_{i}": c.cast("double") for name, (features, _) in sets.items() for i, c in enumerate(features)}
    places = {f"_at_{name}": at.cast("array<long>") for name, (_, at) in sets.items()}
    if history is not None:
        columns["_history"] = history.cast("double")
    kept = rows.select(
        *keys, F.col(position).cast("long").alias("_pos"), ended.alias("ended"), *carry,
        *(c.alias(n) for n, c in {**columns, **places}.items()),
    ).sortWithinPartitions(*keys, "_pos")
    names = [c for c in kept.columns if c not in columns and c not in places and c != "_pos"]
    widths = {name: len(features) for name, (features, _) in sets.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_series(batches):
            starts = np.append(np.flatnonzero(table["_pos"].to_numpy() == 0), table.num_rows)
            wanted = np.flatnonzero(table["ended"].combine_chunks().value_lengths().fill_null(0).to_numpy())
            series = np.searchsorted(starts, wanted, "right") - 1
            out = table.take(pa.array(wanted)).combine_chunks()
            found = []
            for name, width in widths.items():
                x = np.column_stack([np.nan_to_num(table[f"_{name}_{i}"].to_numpy()) for i in range(width)])
                at = out[f"_at_{name}"].to_pylist()
                sums: list[list[list[float]]] = []
                for k in range(len(starts) - 1):
                    part = x[starts[k] : starts[k + 1]]
                    i, j = np.tril_indices(width)
                    total = np.zeros((len(part) + 1, len(i)))
                    np.cumsum(part[:, i] * part[:, j], axis=0, out=total[1:])
                    for r in range(*np.searchsorted(series, [k, k + 1])):
                        to = np.maximum.accumulate(np.minimum(at[r], wanted[r] - starts[k] + 1))
                        sums.append((total[to[1:]] - total[to[:-1]]).tolist())
                found.append(pa.array(sums, pa.list_(pa.list_(pa.float64()))))
            if "history" in more:
                whole = table["_history"].to_numpy()
                seen = [whole[starts[k] : r + 1] if r + 1 == starts[k + 1] else None for k, r in zip(series, wanted)]
                found.append(pa.array(seen, pa.list_(pa.float64())))
            for batch in pa.Table.from_arrays([*(out[c] for c in names), *found], names=[*names, *more]).to_batches():
                yield batch

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*names).schema)
    more = {name: "array<array<double>>" for name in widths} | ({"history": "array<double>"} if history is not None else {})
    return kept.mapInArrow(run, f"{types}, " + ", ".join(f"`{name}` {kind}" for name, kind in more.items()))


def square(triangle: Sequence[float]) -> np.ndarray:
    """The symmetric matrix of a lower triangle."""
    values = np.asarray(triangle, dtype=float)
    size = int((np.sqrt(8 * len(values) + 1) - 1) / 2)
    out = np.zeros((size, size))
    rows, cols = np.tril_indices(size)
    out[rows, cols] = values
    out[cols, rows] = values
    return out


def fit(xx: np.ndarray, xy: np.ndarray, yy: float, use: Sequence[int], ridge: np.ndarray | None = None):
    """Coefficients, residual sum of squares and inverse for a subset of columns; None if singular."""
    a, b = xx[np.ix_(use, use)], xy[list(use)]
    solved = a if ridge is None else a + np.diag(ridge[list(use)])
    try:
        if np.linalg.cond(solved) > 1e13:
            return None
        inverse = np.linalg.inv(solved)
    except np.linalg.LinAlgError:
        return None
    beta = inverse @ b
    rss = float(yy - 2 * beta @ b + beta @ a @ beta)
    if not np.isfinite(beta).all() or not np.isfinite(rss):
        return None
    return beta, max(rss, 0.0), inverse


def dot(coefficients: str, columns: Sequence[Column]) -> Column:
    """Sum of products of an array column with row expressions."""
    out = None
    for i, c in enumerate(columns):
        term = F.get(F.col(coefficients), F.lit(i)) * c
        out = term if out is None else out + term
    return out
