"""Gated, count-verified rebuild of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import require, require_unique
from starloom.sources import SnapshotTable


def rebuild(table: SnapshotTable, source: DataFrame, key: str) -> DataFrame:
    """Replace ``table`` by all rows of ``source``.

    Stops before writing when a key is missing or repeated, and before the
    switch when the copy has other rows than the source.
    """
    require(source.filter(F.col(key).isNull()), f"{key} contains NULL values")
    require_unique(source, key)
    return table.publish(source, expected_rows=source.count())
