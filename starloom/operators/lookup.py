"""Star lookups: business identifiers to surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.constants import UNKNOWN_KEY
from starloom.operators.checks import LoadGateError
from starloom.operators.joins import fits_broadcast, lookup_join
from starloom.session import known_size, part_of, stage_table


@dataclass(frozen=True)
class KeyLookup:
    """How one fact column finds its dimension row.

    ``on_missing='drop'`` removes unmatched fact rows, ``'unknown'`` points them
    at key 0.  ``carry`` adds attributes of the matched row (NULL if none).
    """

    dim: DataFrame
    fact_column: str
    dim_column: str
    key: str
    as_: str = ""
    on_missing: str = "unknown"
    carry: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if self.on_missing not in ("drop", "unknown"):
            raise ValueError(f"on_missing must be 'drop' or 'unknown', not {self.on_missing!r}")

    @property
    def name(self) -> str:
        return self.as_ or self.key

    @cached_property
    def fits(self) -> bool:
        """Whether the dimension may be broadcast; measured once per lookup."""
        return fits_broadcast(part_of(self.dim, self.narrow()))

    def narrow(self) -> DataFrame:
        return self.dim.select(
            F.col(self.dim_column).alias(self._probe),
            F.col(self.key).alias(self._found),
            *self.carry,
        )

    @property
    def _probe(self) -> str:
        return f"_probe_{self.name}"

    @property
    def _found(self) -> str:
        return f"_found_{self.name}"


@dataclass(frozen=True)
class DayLookup(KeyLookup):
    """A lookup in a calendar by day keys (YYYYMMDD), without a join where the calendar has no gap.

    A day key is in a calendar of all days from one to another exactly if it is
    a day and lies between them.  Whether the calendar is one is asked of the
    calendar itself: as many different days as lie between its first and last.
    """

    @property
    def days(self) -> tuple[int, int] | None:
        """The first and last day key, or None if days are missing, doubled or no days; asked once per calendar."""
        known = getattr(self.dim, _DAYS, {})
        if (self.dim_column, self.key) not in known:
            known = {**known, (self.dim_column, self.key): self._days()}
            setattr(self.dim, _DAYS, known)
        return known[self.dim_column, self.key]

    def _days(self) -> tuple[int, int] | None:
        key = F.col(self.dim_column)
        day = F.try_to_date(F.lpad(key.cast("string"), 8, "0"), "yyyyMMdd")
        seen = self.dim.agg(
            F.min(day).alias("a"), F.max(day).alias("b"), F.count("*").alias("rows"), F.count_distinct(day).alias("days"),
            F.count_if(~F.col(self.key).eqNullSafe(key)).alias("other"), F.min(key).alias("low"), F.max(key).alias("high"),
        ).first()
        if not seen["days"] or seen["other"] or not (seen["rows"] == seen["days"] == (seen["b"] - seen["a"]).days + 1):
            return None
        return seen["low"], seen["high"]

    @property
    def joined(self) -> bool:
        return self.days is None or bool(self.carry)

    @cached_property
    def fits(self) -> bool:
        return not self.joined or fits_broadcast(part_of(self.dim, self.narrow()))


_DAYS = "_starloom_days"


def days_of(calendar: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """``calendar``, noted to hold all days from one key to another once, so it need not be asked."""
    setattr(calendar, _DAYS, {(column, column): (low, high)})
    return calendar


def _is_day(key: Column) -> Column:
    """Whether a number YYYYMMDD is a day; arithmetic only, as it is asked of every row of a fact."""
    year, month, day = F.floor(key / 10000), F.floor(key / 100) % 100, key % 100
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return month.between(1, 12) & (day >= 1) & (day <= last)


def _join(fact: DataFrame, look: KeyLookup, row_id, how: str, source: DataFrame) -> DataFrame:
    if isinstance(look, DayLookup) and not look.joined:
        value = F.col(look.fact_column)
        known = value.between(*look.days) & _is_day(value)
        found = fact.withColumn(look._found, F.when(known, value))
        return found.filter(F.col(look._found).isNotNull()) if how == "inner" else found
    value = F.col(look.fact_column)
    return lookup_join(
        fact.withColumn(look._probe, value), look.narrow(), look._probe, how, row_id,
        measure=source.select(value.alias(look._probe)), fits=look.fits,
    ).drop(look._probe)


def resolve_keys(
    fact: DataFrame, lookups: Sequence[KeyLookup], row_id: str | Sequence[str]
) -> DataFrame:
    """Add one surrogate key column per lookup.

    Small dimensions come first: they are broadcast and, when they drop rows,
    they do so before anything is shuffled.  Hot keys are looked for in
    ``fact`` as given, so it should be a stored table.
    """
    source = fact
    for look in sorted(lookups, key=lambda x: not x.fits):
        drop = look.on_missing == "drop"
        fact = _join(fact, look, row_id, "inner" if drop else "left", source)
        found: Column = F.col(look._found)
        if not drop:
            found = F.coalesce(found, F.lit(UNKNOWN_KEY))
        fact = fact.withColumn(look.name, found).drop(look._found)
    return fact


def _unmatched(joined: DataFrame, lookups: Sequence[KeyLookup]) -> DataFrame:
    counts = [
        F.struct(
            F.lit(look.name).alias("Lookup"),
            F.lit(look.on_missing).alias("OnMissing"),
            F.count_if(F.col(look._found).isNull()).alias("UnmatchedRows"),
        )
        for look in lookups
    ]
    return joined.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def _joined(
    fact: DataFrame, lookups: Sequence[KeyLookup], row_id: str | Sequence[str], measure: DataFrame | None = None
) -> DataFrame:
    source = fact if measure is None else measure
    for look in sorted(lookups, key=lambda x: not x.fits):
        fact = _join(fact, look, row_id, "left", source)
    return fact


def unmatched_rows(
    fact: DataFrame, lookups: Sequence[KeyLookup], row_id: str | Sequence[str]
) -> DataFrame:
    """Rows of ``fact`` each lookup does not match, all counted in one pass."""
    return _unmatched(_joined(fact, lookups, row_id), lookups)


def resolve_once(
    fact: DataFrame, lookups: Sequence[KeyLookup], row_id: str | Sequence[str],
    keep: Sequence[str] | None = None, rows: int | None = None, measure: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows with their keys, unmatched counts), both from one run of the joins.

    The joined rows are written with what every lookup found; dropping rows,
    counting the unmatched and numbering what is left then read that table.
    A dimension with a key twice would multiply rows: then nothing is loaded.

    Of the fact's columns only ``keep`` are written, if given.  Where ``fact`` is costly to
    compute, pass its number of ``rows``, and as ``measure`` the stored table it comes from.
    """
    joined = _joined(fact, lookups, row_id, measure)
    if keep is not None:
        joined = joined.select(*keep, *[look._found for look in lookups])
    stored = stage_table(joined, "resolved")
    before = rows if rows is not None else known_size(fact)[0] if known_size(fact) else fact.count()
    if known_size(stored)[0] != before:
        keys = ", ".join(look.name for look in lookups)
        raise LoadGateError(f"duplicate keys in a dimension of {keys}: {before} rows became {known_size(stored)[0]}")
    result = stored
    for look in lookups:
        found = F.col(look._found)
        if look.on_missing == "drop":
            result = result.filter(found.isNotNull())
        result = result.withColumn(look.name, F.coalesce(found, F.lit(UNKNOWN_KEY)))
    result = result.drop(*[look._found for look in lookups])
    return part_of(stored, result), _unmatched(stored, lookups)
