"""Profiling: frequencies, duplicates, missing and invalid values, totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import is_blank


def value_frequency(df: DataFrame, columns: str | Sequence[str], name: str = "RecordCount") -> DataFrame:
    """Rows per value, most frequent first."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), *[F.asc_nulls_first(c) for c in columns])
    )


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], name: str = "DuplicateCount") -> DataFrame:
    """Keys that occur more than once."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def missing_profile(
    df: DataFrame,
    required: Mapping[str, str] | None = None,
    text: Mapping[str, str] | None = None,
    rows: str | None = None,
) -> DataFrame:
    """One row of missing-value counts, in one pass.

    ``required`` counts NULLs, ``text`` NULLs and blanks; both map a column to
    the name of its count.  ``rows`` adds the row count under that name.
    """
    counts = [F.count("*").alias(rows)] if rows else []
    counts += [F.count_if(F.col(c).isNull()).alias(n) for c, n in (required or {}).items()]
    counts += [F.count_if(is_blank(c)).alias(n) for c, n in (text or {}).items()]
    return df.agg(*counts)


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows meet each condition."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def control_totals(
    df: DataFrame,
    sums: Mapping[str, str],
    rows: str | None = None,
    by: Sequence[str] = (),
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row count, exact distinct counts and sums, overall or per group.

    Sums are widened: integers to 64 bits, money to 38 digits.
    """
    aggregates = [F.count("*").alias(rows)] if rows else []
    aggregates += [F.count_distinct(c).alias(n) for c, n in (distinct or {}).items()]
    for column, name in sums.items():
        value = F.sum(column)
        if df.schema[column].dataType.typeName() == "decimal":
            value = value.cast("decimal(38,2)")
        aggregates.append(value.alias(name))
    return df.groupBy(*by).agg(*aggregates)
