"""Spatial tables: outlines parsed once, clustered in space, with plain boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.functions import geometry as g
from loamframe.session import scratch_path

ROW_GROUP_BYTES = 4 << 20
_BITS = 16


def _spread(v: Column) -> Column:
    """A gap before each of the low 16 bits."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def curve(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Place of a point on a Z-order curve through a box (2**16 steps a side)."""
    x0, y0, x1, y1 = box

    def step(value: Column, low: float, high: float) -> Column:
        part = (value - low) / max(high - low, 1e-300) * (1 << _BITS)
        return F.greatest(F.lit(0), F.least(F.lit((1 << _BITS) - 1), F.floor(part))).cast("long")

    return _spread(step(x, x0, x1)).bitwiseOR(F.shiftleft(_spread(step(y, y0, y1)), 1))


def write_spatial_table(df: DataFrame, wkt: str, path: str) -> None:
    """Rows with a usable outline, with ``geometry.SHAPE_COLUMNS``, as Parquet.

    Every outline is parsed here, once, in as many tasks as the session has
    shuffle partitions, however few files the source has. Rows are then ranged
    along a Z-order curve through the centres of their boxes and written in
    small row groups, so the statistics of ``_xmin`` ... ``_ymax`` let a query by
    box skip what lies elsewhere. Null, malformed and invalid outlines drop out,
    as in ``geometry.with_shape``; an empty table gives an empty one.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parsed_path = scratch_path(spark, "outlines")
    g.with_shape(df.repartition(parts), wkt).write.parquet(parsed_path)
    parsed = spark.read.parquet(parsed_path)
    x, y = (F.col("_xmin") + F.col("_xmax")) / 2, (F.col("_ymin") + F.col("_ymax")) / 2
    bounds = parsed.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    place = curve(x, y, tuple(v or 0.0 for v in bounds))
    # The row number splits a spot with many outlines.
    ranged = parsed.withColumns({"_place": place, "_row": F.monotonically_increasing_id()})
    ranged = ranged.repartitionByRange(parts, "_place", "_row").sortWithinPartitions("_place", "_row").drop("_place", "_row")
    ranged.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
