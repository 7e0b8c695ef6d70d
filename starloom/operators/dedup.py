"""One row per key.

``row_number() = 1`` is planned with a partial group limit before the shuffle,
so every map task sends at most one row per key: a key that holds a third of
the table does not arrive in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def preferred_per_key(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """First row of each key in ``order``; rows without a key are dropped.

    Columns not named in ``order`` break ties in ascending order, so the choice
    never depends on how the rows happen to be laid out.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    named = {o for o in order if isinstance(o, str)} | set(keys)
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in named]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return (
        df.filter(reduce(and_, [F.col(c).isNotNull() for c in keys]))
        .withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    latest: str | Sequence[str],
    ties: Sequence[Column | str] = (),
) -> DataFrame:
    """Most recent row of each key by ``latest``, then by ``ties``, then by the rest."""
    latest = [latest] if isinstance(latest, str) else list(latest)
    return preferred_per_key(df, keys, [F.col(c).desc_nulls_last() for c in latest] + list(ties))
