"""Groups of rows compared inside tasks: even tasks for hot groups, whole groups out of sorted batches, local union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parts_for(rows: int) -> int:
    """Partitions for rows that cost far more to compare than to read: 20,000 each, more once there are thousands of parts."""
    return 8 + min(rows // 20_000, 5_000 + rows // 5_000_000)


def dealt(rows: DataFrame, keys: list[str], chunks: Column, spread: Column, parts: int) -> DataFrame:
    """``rows`` sorted by task, where a task compares chunk ``_i`` with chunk ``_j`` of one group; ``_own`` is a row's chunk.

    A group with ``chunks`` > 1 is cut evenly by the hash ``spread`` into that many chunks, and each row goes to the tasks
    of its chunk with each other one, so that a hot group becomes many tasks of bounded size in which every pair of its
    rows still meets exactly once.
    """
    cut = rows.withColumn("_n", chunks.cast("int")).withColumn("_own", F.pmod(spread, F.col("_n")).cast("int"))
    each = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    tasks = each.withColumn("_i", F.least("_own", "_other")).withColumn("_j", F.greatest("_own", "_other")).drop("_other", "_n")
    order = [*keys, "_i", "_j"]
    return tasks.repartition(parts, *order).sortWithinPartitions(*order, "_own")


def whole_groups(batches, keys: list[str], rows: int = 1 << 18) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that end where a group ends; the batches are sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            new = group_starts(table, keys)
            cut = int(new[-1])
            if cut:
                yield table.slice(0, cut)
                held, n = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a new group begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = np.asarray(table.column(key))
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class Labels:
    """Union-find over places 0 to n - 1; every place is labelled with the smallest place of its set."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return
        parent = np.arange(len(label))
        while apart.any():
            a, b = a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            a, b = parent[a], parent[b]
            apart = a != b
        self.label = parent[label]
