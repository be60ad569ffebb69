"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brieflow.session import scratch_path

#: A group that holds more than 1 / HOT_PARTS of all rows is hot, so there are fewer than HOT_PARTS hot groups.
HOT_PARTS = 10_000
HOT_LEAST = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again: later steps neither recompute it
    nor depend on the executors that made it, and the planner knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column and the n + 1 offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in portions, so a task holds the Python values of few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def attach_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key`` (a column or several) of ``groups``.

    ``size`` is the number of rows of the group. Fewer than ``HOT_PARTS`` groups can hold over
    ``total / HOT_PARTS`` rows; these are broadcast, so their many rows are not dealt to one task.
    All other groups join by shuffle.
    """
    key = [key] if isinstance(key, str) else key
    limit = max(total // HOT_PARTS, HOT_LEAST)
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    cold = groups.filter(F.col(size) <= limit)
    return rows.join(hot, key).unionByName(rows.join(hot.select(*key), key, "left_anti").join(cold, key))
