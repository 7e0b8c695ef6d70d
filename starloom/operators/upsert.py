"""Type-1 loading on immutable files: the result is a new snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.constants import OPEN_END, UNKNOWN_KEY
from starloom.operators.checks import require_unique
from starloom.operators.joins import fits_broadcast
from starloom.operators.keys import assign_keys, max_key
from starloom.session import known_size, local_rows, part_of, stage_table

#: a target of up to this many rows is matched without writing a merged copy
SHORT_ROWS = 1_000

#: what the load did with a row: 'kept', 'updated' or 'inserted'
ACTION = "_action"
_IN_TARGET, _IN_SOURCE, _S = "_in_target", "_in_source", "_s_"


def new_rows(
    source: DataFrame, target: DataFrame, key: str | Sequence[str], increment: bool = False
) -> DataFrame:
    """Source rows whose key the target does not have.

    With ``increment`` the source's keys are broadcast, if they are few enough,
    to find the hits where the target lies; only those are then joined, and the
    target is not shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = target.select(*keys)
    wanted = source.select(*keys)
    if increment and fits_broadcast(wanted):
        known = known.join(F.broadcast(wanted), keys, "left_semi")
    return source.join(known, keys, "left_anti")


def new_rows_by_key(
    source: DataFrame, target: DataFrame, key: str, rows: int
) -> tuple[DataFrame, int]:
    """(source rows whose key the target does not have, how many), of a stored source of ``rows`` rows, one per key.

    The keys are compared by themselves.  The other columns are shuffled only
    where some rows are new, others are not, and the new keys are too many to broadcast.
    """
    fresh = stage_table(new_rows(source.select(key), target, key, increment=True), "new_keys")
    n = known_size(fresh)[0]
    if n == rows:
        return source, n
    return source.join(F.broadcast(fresh) if fits_broadcast(fresh) else fresh, key, "left_semi"), n


def update_matched(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    protect: Column | None = None,
) -> DataFrame:
    """Overwrite ``update`` columns of the target rows the source also has.

    Rows where ``protect`` holds keep their values.  Adds the action column.
    """
    require_unique(source, key)
    incoming = source.select(
        key, *[F.col(c).alias(_S + c) for c in update], F.lit(True).alias(_IN_SOURCE)
    )
    hit = F.col(_IN_SOURCE).isNotNull()
    if protect is not None:
        hit = hit & ~F.coalesce(protect, F.lit(False))
    joined = target.join(incoming, key, "left").withColumn(
        ACTION, F.when(hit, "updated").otherwise("kept")
    )
    return joined.select(
        *[
            F.when(F.col(ACTION) == "updated", F.col(_S + c)).otherwise(F.col(c)).alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ],
        ACTION,
    )


def insert_new(
    target: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str | None = None,
    check_source: bool = True,
) -> DataFrame:
    """Target plus the source rows with new keys; adds the action column."""
    if check_source:
        require_unique(source, key)
    fresh = new_rows(source, target, key)
    if surrogate:
        fresh = stage_table(fresh, "fresh")
        kind = target.schema[surrogate].dataType.simpleString()
        fresh = assign_keys(
            fresh, key, surrogate, max_key(target, surrogate) + 1, kind, max_rows=known_size(fresh)[0],
            stored=True,
        )
    return target.withColumn(ACTION, F.lit("kept")).unionByName(
        _shaped(fresh, target).withColumn(ACTION, F.lit("inserted"))
    )


def _shaped(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with exactly the columns and types of ``target``."""
    return source.select(
        *[
            (F.col(f.name) if f.name in source.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    surrogate: str,
    protect: Column | None = None,
    scope: Column | None = None,
    check_source: bool = True,
) -> DataFrame:
    """Overwrite matched rows, add new ones with the next surrogate keys.

    ``scope`` limits which target rows count as existing (the current ones);
    the others are carried over.  ``protect`` marks matched rows that must not
    change (the unknown member).  One full outer join serves both halves, so
    each side is shuffled once, and its rows are written once before the
    inserted ones are keyed.  A short target, as on a first load, is broadcast
    instead, and nothing is written twice; pass a stored source.

    The result has the target's columns plus ``_action``.
    """
    if check_source:
        require_unique(source, key)
    carried = None
    live = target
    if scope is not None:
        in_scope = F.coalesce(scope, F.lit(False))
        live, carried = target.filter(in_scope), target.filter(~in_scope)

    shaped = [c for c in target.columns if c in source.columns and c != key]
    incoming = source.select(
        key, *[F.col(c).alias(_S + c) for c in shaped], F.lit(True).alias(_IN_SOURCE)
    )
    changed = F.col(_IN_SOURCE).isNotNull()
    if protect is not None:
        changed = changed & ~F.coalesce(protect, F.lit(False))

    def value(name: str) -> Column:
        kind = target.schema[name].dataType
        if name == key:
            return F.col(key).cast(kind).alias(key)
        if name not in shaped:
            return F.col(name)
        take = F.col(ACTION) == "inserted"
        if name in update:
            take = take | (F.col(ACTION) == "updated")
        return F.when(take, F.col(_S + name).cast(kind)).otherwise(F.col(name)).alias(name)

    columns = [value(c) for c in target.columns]
    did = F.when(changed, "updated").otherwise("kept")
    few = live.limit(SHORT_ROWS + 1).collect()
    if max(len(few), (known_size(source) or (SHORT_ROWS + 1,))[0]) <= SHORT_ROWS and scope is None and protect is None:
        return _short_upsert(target, few, source, key, update, surrogate)
    if len(few) <= SHORT_ROWS:
        # the few rows go to the source, and the new rows are numbered as they come
        live = local_rows(live.sparkSession, few, live.schema)
        known = F.broadcast(live.select(key))
        old = live.join(
            incoming.join(known, key, "left_semi"), key, "left"
        ).withColumn(ACTION, did).select(*columns, ACTION)
        new = _shaped(source.join(known, key, "left_anti"), target).withColumn(ACTION, F.lit("inserted"))
        last = max((r[surrogate] for r in few if r[surrogate] is not None), default=0)
        # at most the rows of the source
        n_new = known_size(source)[0] if known_size(source) else new.count()
    else:
        joined = (
            live.withColumn(_IN_TARGET, F.lit(True))
            .join(incoming, key, "full_outer")
            .withColumn(ACTION, F.when(F.col(_IN_TARGET).isNull(), "inserted").otherwise(did))
        )
        merged = stage_table(joined.select(*columns, ACTION), "merged")
        inserted = F.col(ACTION) == "inserted"
        seen = merged.agg(
            F.coalesce(F.max(surrogate), F.lit(0)).alias("last"), F.count_if(inserted).alias("new")
        ).first()
        old, new, last, n_new = merged.filter(~inserted), merged.filter(inserted), seen["last"], seen["new"]
    result = old
    if n_new:
        if carried is not None:
            last = max(last, max_key(carried, surrogate))
        kind = target.schema[surrogate].dataType.simpleString()
        result = result.unionByName(
            assign_keys(new.drop(surrogate), key, surrogate, last + 1, kind, max_rows=n_new, stored=True)
        )
    if carried is not None:
        result = result.unionByName(carried.withColumn(ACTION, F.lit("kept")))
    return result


def _short_upsert(
    target: DataFrame, few: Sequence[Row], source: DataFrame, key: str, update: Sequence[str], surrogate: str
) -> DataFrame:
    """The upsert where both sides have up to ``SHORT_ROWS`` rows, as lookups have: no join and nothing written."""
    names = target.columns
    incoming = _shaped(source, target).collect()
    by_key = {r[key]: r for r in incoming if r[key] is not None}
    take = [c for c in update if c in source.columns]
    out, known = [], set()
    for row in few:
        values, match = row.asDict(), by_key.get(row[key])
        if match is not None:
            values |= {c: match[c] for c in take}
            known.add(row[key])
        out.append([*(values[c] for c in names), "kept" if match is None else "updated"])
    last = max((r[surrogate] for r in few if r[surrogate] is not None), default=0)
    new = sorted((r for r in incoming if r[key] not in known), key=lambda r: (r[key] is not None, r[key]))
    for number, row in enumerate(new, last + 1):
        out.append([*(number if c == surrogate else row[c] for c in names), "inserted"])
    return local_rows(target.sparkSession, out, T.StructType([*target.schema.fields, T.StructField(ACTION, T.StringType())]))


def as_current(source: DataFrame, effective_from: Column | str | dt.date) -> DataFrame:
    """The source as current rows of a dimension, valid from ``effective_from``."""
    since = (
        F.lit(effective_from)
        if isinstance(effective_from, dt.date)
        else F.col(effective_from) if isinstance(effective_from, str) else effective_from
    )
    dated = (
        source.withColumn("EffectiveFrom", since.cast("date"))
        .withColumn("EffectiveTo", F.lit(OPEN_END))
        .withColumn("IsCurrent", F.lit(True))
    )
    return part_of(source, dated)


def upsert_current(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    surrogate: str,
    effective_from: Column | str | dt.date,
    protect: Column | None = None,
) -> DataFrame:
    """Upsert against the current rows; new rows become valid from ``effective_from``.

    Changes overwrite the current row (type 1); no history row is made.
    """
    dated = as_current(source, effective_from)
    return upsert(
        target, dated, key, update, surrogate, protect=protect, scope=F.col("IsCurrent")
    )


def action_counts(result: DataFrame) -> DataFrame:
    """One row: how many rows the load updated, inserted and kept."""
    did = F.col(ACTION)
    return result.agg(
        F.count_if(did == "updated").alias("UpdatedRows"),
        F.count_if(did == "inserted").alias("InsertedRows"),
        F.count_if(did == "kept").alias("KeptRows"),
    )


def ensure_unknown(dim: DataFrame, key: str, row: Mapping[str, object]) -> DataFrame:
    """Add the unknown member (key 0) unless the dimension already has it."""
    values = {**row, key: UNKNOWN_KEY}
    unknown = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    present = dim.filter(F.col(key) == UNKNOWN_KEY).select(key)
    return dim.unionByName(unknown.join(present, key, "left_anti"))
