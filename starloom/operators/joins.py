"""Looking a large table up in a smaller one, whatever the sizes and the skew.

A side is broadcast only after its rows and bytes were measured against a
bound.  Beyond the bound the join shuffles, and keys that hold more than their share of the
rows are sliced, so no task gets a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import byte_size, known_size

#: largest lookup that is broadcast, in rows and in bytes
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
#: a key is never sliced below this many rows
SLICE_ROWS = 1_000_000

_SALT, _SLICES, _HOT = "_salt", "_slices", "_hot"


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most so many rows and bytes.

    A stage table's size is known from its write.  Otherwise every task sends one partial sum, so the check costs a scan of the columns
    given and moves nothing; pass stored tables and only the columns needed.
    """
    known = known_size(df)
    if known is not None and known[0] <= max_rows and known[1] <= max_bytes:
        return True
    seen = df.agg(F.count("*").alias("rows"), byte_size(df).alias("bytes")).first()
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def hot_keys(fact: DataFrame, key: str, slice_rows: int | None = None) -> DataFrame | None:
    """Keys larger than an average shuffle partition, with the slices each needs.

    Every task keeps a sketch of its frequent keys, of a size that follows the
    partitions, so nothing is exchanged per key.  Fewer keys than shuffle partitions
    can exceed an average partition, so the result is small by construction.  A key
    near the bound may be taken or not, which changes the work and never the join.
    """
    spark = fact.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fact.count()
    slice_rows = max(slice_rows or SLICE_ROWS, rows // partitions)
    if rows <= slice_rows:
        return None
    kind = fact.schema[key].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType, T.DateType)):
        hot = (
            fact.groupBy(F.col(key).alias(_HOT))
            .agg(F.count("*").alias("_n"))
            .filter(F.col("_n") > slice_rows)
            .select(_HOT, F.ceil(F.col("_n") / slice_rows).cast("int").alias(_SLICES))
        )
        found, schema = hot.collect(), hot.schema
    else:
        # a sketch of the frequent keys per task, off by far less than a partition
        most = min(max(partitions, 10), 10_000)
        seen = fact.agg(
            F.count_if(F.col(key).isNull()).alias("nulls"),
            F.expr(f"approx_top_k(`{key}`, {most}, {32 * most})").alias("top"),
        ).first()
        counts = [(None, seen["nulls"]), *((r["item"], r["count"]) for r in seen["top"] if r["item"] is not None)]
        found = [(value, -(-n // slice_rows)) for value, n in counts if n > slice_rows]
        schema = T.StructType([T.StructField(_HOT, kind), T.StructField(_SLICES, T.IntegerType())])
    return spark.createDataFrame(found, schema) if found else None


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str,
    row_id: str | Sequence[str],
    measure: DataFrame | None = None,
    fits: bool | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Inner or left join of ``fact`` to ``dim`` on the column ``key`` both have.

    ``row_id`` identifies a fact row; it spreads a hot key over its slices the
    same way on every attempt.  ``measure`` is a stored table with the same key
    column to find the hot keys in, where ``fact`` itself is costly to compute:
    which keys are sliced changes the work, never the result.  ``fits`` passes
    on a size check already made.
    """
    columns = fact.columns + [c for c in dim.columns if c != key]
    if fits_broadcast(dim) if fits is None else fits:
        return fact.join(F.broadcast(dim), key, how).select(*columns)
    hot = hot_keys(fact if measure is None else measure, key, slice_rows)
    if hot is None:
        return fact.join(dim, key, how).select(*columns)
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    # rows without a key match nothing but would still meet in one partition
    salted = (
        fact.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(_HOT)), "left")
        .withColumn(
            _SALT,
            F.coalesce(F.pmod(F.xxhash64(*ids), F.col(_SLICES)).cast("int"), F.lit(0)),
        )
        .drop(_HOT, _SLICES)
    )
    copies = (
        dim.join(F.broadcast(hot), F.col(key) == F.col(_HOT), "left")
        .withColumn(
            _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SLICES), F.lit(1)) - 1))
        )
        .drop(_HOT, _SLICES)
    )
    return salted.join(copies, [key, _SALT], how).select(*columns)
