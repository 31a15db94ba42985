"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.session import shuffles_removed  # noqa: F401


SLICE_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def tasks(spark: SparkSession, factor: int = 1) -> int:
    """Number of shuffle partitions the session asks for, times ``factor``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * factor)


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in order, cut where another ``size`` bytes of the text in
    ``column`` begin: what Python makes of a batch is many times its text, so a
    task holds that of one slice only. Batches without rows are left out."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // size
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        for start, end in zip(starts, starts[1:]):
            if end > start:
                yield b.slice(start, end - start)
