"""Dense surrogate keys without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import local_rows, stage_table

#: up to this many rows are numbered by one sorted task
SMALL_ROWS = 100_000

_ID, _PART = "_row_id", "_part"
# monotonically_increasing_id keeps the partition above bit 33, the row below
_ROW_BITS = 33


def max_key(df: DataFrame, key: str) -> int:
    """Largest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("k")).first()["k"]


def assign_keys(
    df: DataFrame,
    order: str | Sequence[str | Column],
    key: str,
    start: int = 1,
    kind: str = "bigint",
    max_rows: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add ``key`` = start, start+1, … in ``order``, which must be unique per row.

    Rows counted or bounded beforehand (``max_rows``) to be few are numbered by
    one task.  Otherwise the rows are range-partitioned and sorted, and written with their
    position inside the partition.  Adding the size of the earlier partitions
    (one number per partition) then gives the key in a map-only step.  Finding
    the ranges reads the rows a first time, so they are written before unless
    ``stored`` says that reading them is cheap.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order)
    if max_rows is not None and max_rows <= SMALL_ROWS:
        number = F.row_number().over(Window.orderBy(*order))
        return df.select((F.lit(start - 1) + number).cast(kind).alias(key), *df.columns)
    placed = (
        (df if stored else stage_table(df, "unkeyed")).repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_ID, F.monotonically_increasing_id())
    )
    staged = stage_table(placed, "keyed").withColumn(_PART, F.shiftright(_ID, _ROW_BITS))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(_PART)
        .agg(F.count("*").alias("_rows"))
        .select(_PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # at most one row per shuffle partition; counted once, however often the keys are read
    offsets = local_rows(df.sparkSession, offsets.collect(), offsets.schema)
    position = F.col(_ID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        staged.join(F.broadcast(offsets), _PART)
        .withColumn(key, (F.lit(start) + F.col("_before") + position).cast(kind))
        .select(key, *df.columns)
    )
