"""Rows that share a key, read as runs of a sorted partition in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that meet in a task. A larger key is cut into cells of this size, and every pair
# of cells becomes a run, so that no pair of rows is lost and no task holds more than two cells.
CELL = 4096


def into_cells(keyed: DataFrame, key: str, salt: Column, cell: int = CELL) -> DataFrame:
    """``keyed`` with ``cell``, ``left`` and ``right``: the pair of cells that a copy of the row is for.

    Keys up to ``cell`` rows have the one pair (0, 0). Only the larger ones, of which there are at most
    rows / ``cell``, are listed and joined.
    """
    hot = keyed.groupBy(key).count().filter(F.col("count") > cell).select(
        F.col(key).alias("_key"), F.ceil(F.col("count") / F.lit(cell / 2)).cast("int").alias("_cells")
    )
    own = F.pmod(salt, F.coalesce("_cells", F.lit(1))).cast("int")
    return (
        keyed.join(hot, F.col(key) == F.col("_key"), "left")
        .withColumn("cell", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.coalesce("_cells", F.lit(1)) - 1)))
        .withColumn("left", F.least("cell", "_other"))
        .withColumn("right", F.greatest("cell", "_other"))
        .drop("_key", "_cells", "_other")
    )


def sorted_runs(cells: DataFrame, key: str) -> DataFrame:
    """Rows of a run next to each other in one partition."""
    return cells.repartition(key, "left", "right").sortWithinPartitions(key, "left", "right")


def whole_runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete runs of equal ``names``, and the index one past the end of each row's run."""
    held: list[pa.RecordBatch] = []

    def ready(table: pa.Table) -> tuple[int, np.ndarray]:
        columns = [table.column(n).to_numpy() for n in names]
        new = np.zeros(table.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.nonzero(new)[0]])
        ends = np.concatenate([starts[1:], [table.num_rows]])
        return int(starts[-1]), np.repeat(ends, ends - starts)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([*held, batch])
        last, end = ready(table)
        if last:
            yield table.slice(0, last), end[:last]
        held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, ready(table)[1]


def pairs_by_distance(end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays of all pairs of a run, first all neighbours, then those two apart, and so on."""
    at = np.arange(len(end))
    step = 1
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            return
        yield at, at + step
        step += 1


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links ``a``-``b``; a label is the index of a row of the same group."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
