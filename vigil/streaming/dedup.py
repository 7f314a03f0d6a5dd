"""Replay-safe deduplication on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.schema import WATERMARK_DELAY

FOLD_ROWS = 100_000


def fold_in_task(df: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """One row a key of what each task reads (of each ``FOLD_ROWS`` rows, which bounds its
    memory), before anything is shuffled: the latest, so a copy that is not late stays
    where there is one.  Null keys are keys like others.
    """
    keys = list(keys)

    def folded(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        t = pa.Table.from_batches(parts)
        seen = t.select([*keys, *([] if time_col in keys else [time_col])]).to_pandas()
        kept = seen.sort_values(time_col, ascending=False, kind="stable", na_position="last") \
            .drop_duplicates(keys).index
        return t.take(pa.array(sorted(kept), pa.int64())).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= FOLD_ROWS:
                yield from folded(held)
                held, n = [], 0
        if held:
            yield from folded(held)

    return df.mapInArrow(run, df.schema)


def dedup_events(df: DataFrame, keys: Sequence[str], time_col: str,
                 delay: str = WATERMARK_DELAY) -> DataFrame:
    """Drop repeats of the same key that arrive within the watermark delay.

    State is kept per key only until the watermark passes the first
    occurrence's event time plus the delay, so it stays bounded on an
    unbounded stream.  Each task folds its own repeats first, so a hot key of a
    micro-batch costs the state task one row for each task that read it.  On a batch
    it is a plain ``dropDuplicates``, which folds in each task by itself.
    """
    if df.isStreaming:
        return fold_in_task(df, keys, time_col).withWatermark(time_col, delay) \
            .dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))
