"""Small groups in bulk, and rows whose key is wanted."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys are broadcast up to this number (some 100 MB); more are joined by a shuffle.
MAX_BROADCAST = 2_000_000


def _keys(keyed: DataFrame, key: str) -> DataFrame:
    keys = keyed.select(key).distinct()
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST else keys


def among(df: DataFrame, keyed: DataFrame, key: str = "id") -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keyed`` (a written table)."""
    return df.join(_keys(keyed, key), key, "left_semi")


def without(df: DataFrame, keyed: DataFrame, key: str = "id") -> DataFrame:
    """The rows of ``df`` whose ``key`` is null or not in ``keyed`` (a written table)."""
    return df.join(_keys(keyed, key), key, "left_anti")


def by_group(df: DataFrame, keys: list[str], func: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``func`` on the rows of every group, each a table.  Rows are dealt out
    and sorted by key and streamed, so that many small groups share a batch;
    a task holds one batch and one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            new = np.zeros(len(table), bool)
            for key in keys:
                values = table.column(key).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            borders = [0, *np.flatnonzero(new).tolist()]
            rest = table.slice(borders[-1])
            out = [func(table.slice(a, b - a)) for a, b in zip(borders[:-1], borders[1:])]
            out = [t for t in out if len(t)]
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
        if rest is not None and len(rest):
            yield from func(rest).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
