"""Whole series handed to Python many at a time, for recursions that have no built-in form.

A group a call costs some milliseconds however short the series is, so with many short series the calls are the
work. Here rows are dealt and sorted by series, and a task cuts its stream of Arrow batches only where a series
ends: memory is that of a batch of rows or of the longest series, whatever the number of series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 60_000


def starts(keys: pa.ChunkedArray) -> np.ndarray:
    """First row of each run of equal keys; missing keys are equal."""
    codes = keys.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.diff(codes, prepend=-2))


def whole_series(batches: Iterable[pa.RecordBatch], key: str, rows: int = BATCH_ROWS) -> Iterator[pa.Table]:
    """Tables of some `rows` rows of batches sorted by `key`; no series is cut."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        cut = int(starts(table[key])[-1])
        if cut:
            yield table.slice(0, cut)
            held, count = table.slice(cut).to_batches(), table.num_rows - cut
    if count:
        yield pa.Table.from_batches(held)


def dealt(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows dealt by series, each series in `order`: what `mapped` reads."""
    return df.repartition(key).sortWithinPartitions(F.col(key), *order)


def mapped(df: DataFrame, key: str, compute: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """`compute` (rows of whole series in order, first row of each series) over all series of a `dealt` table, staged or not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_series(batches, key):
            made = compute(table, starts(table[key]))
            if made.num_rows:
                yield from made.to_batches(max_chunksize=10_000)

    return df.mapInArrow(run, schema)


def over_series(df: DataFrame, key: str, order: Sequence[Column], compute: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """`compute` over all series of `df`, each in `order`."""
    return mapped(dealt(df, key, order), key, compute, schema)


def with_series_columns(
    df: DataFrame, key: str, order: str, inputs: Sequence[str], out: Sequence[str], compute: Callable[[pd.DataFrame, np.ndarray], dict[str, np.ndarray]]
) -> DataFrame:
    """`df` with the double columns `out` that `compute` makes of `inputs` and the number of each row's series; missing where NaN."""
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def step(table: pa.Table, first: np.ndarray) -> pa.Table:
        number = np.repeat(np.arange(len(first)), np.diff(first, append=table.num_rows))
        made = compute(table.select(list(inputs)).to_pandas().astype("float64"), number)
        for c in out:
            table = table.append_column(c, pa.array(np.asarray(made[c]), pa.float64(), from_pandas=True))
        return table

    return over_series(df, key, [F.col(order).asc_nulls_last()], step, f"{base}, " + ", ".join(f"`{c}` double" for c in out))
