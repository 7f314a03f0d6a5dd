"""Groups of rows that meet in one task: bounded cells, streamed from Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(rows: DataFrame, group: str, sizes: DataFrame, parts: int, by: str = "id") -> DataFrame:
    """Deal ``rows`` to cells (group, i, j), so that any two rows of a group meet in one.

    ``sizes`` (group, n_blocks) says into how many blocks a group is cut; a row goes
    to the cells of its block with each block, n_blocks in all.  Rows of groups
    that ``sizes`` does not name are left out.  The result is partitioned and
    sorted by cell.
    """
    s = sizes.select(F.col(group).alias("_g"), "n_blocks")
    block = F.pmod(F.xxhash64(by), F.col("n_blocks")).cast("int")
    dealt = rows.join(s, rows[group] == s["_g"]).withColumn("_b", block) \
        .withColumn("_o", F.explode(F.sequence(F.lit(0), (F.col("n_blocks") - 1).cast("int")))) \
        .withColumn("i", F.least("_b", "_o")).withColumn("j", F.greatest("_b", "_o"))
    return dealt.drop("_g", "_b", "_o", "n_blocks").repartition(parts, group, "i", "j") \
        .sortWithinPartitions(group, "i", "j", by)


def stream(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Whole groups of equal keys from batches sorted by them."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        new = np.zeros(b.num_rows, bool)
        for k in key:
            x = b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for a, e in zip(edges[:-1], edges[1:]):
            piece = b.slice(a, e - a)
            if rest and any(rest[0].column(i)[0] != piece.column(i)[0] for i in
                            (b.schema.get_field_index(k) for k in key)):
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(piece)
    if rest:
        yield pa.Table.from_batches(rest)


def spanning(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges that connect what is connected: ``near(i, js)`` says which of js link to i.

    Breadth first: every reached row is compared with all rows not reached yet,
    so no link between two parts is missed, and settled rows cost nothing more.
    """
    left = np.arange(n)
    edges: list[tuple[int, int]] = []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
            continue
        i = queue.pop()
        hit = near(i, left)
        new = left[hit]
        edges += [(i, j) for j in new.tolist()]
        queue += new.tolist()
        left = left[~hit]
    return edges
