"""Date keys, ages and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.constants import UNKNOWN_DATE_KEY, UNKNOWN_TEXT
from starloom.functions.codes import _col


def date_key(c: Column | str, missing: int | None = UNKNOWN_DATE_KEY) -> Column:
    """YYYYMMDD integer; NULL dates become ``missing``.

    Arithmetic on the date parts, not formatting: no string is built per row.
    """
    c = _col(c)
    key = (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
    return key if missing is None else F.coalesce(key, F.lit(missing))


def year_diff(start: Column | str, end: Column | dt.date) -> Column:
    """Number of new-year boundaries between two dates (not full years)."""
    last = F.lit(end) if isinstance(end, dt.date) else end
    return F.year(last) - F.year(_col(start))


def age_band(start: Column | str, end: Column | dt.date) -> Column:
    years = year_diff(start, end)
    return (
        F.when(_col(start).isNull(), UNKNOWN_TEXT)
        .when(years.between(1, 4), "1-4 Years")
        .when(years.between(5, 9), "5-9 Years")
        .otherwise("Other")
    )


def year_month_label(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM``."""
    return F.concat_ws("-", _col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0"))


def century_timestamp(c: Column | str, century: str = "19") -> Column:
    """``yyMMdd HH:mm:ss`` text with the century put in front; any other text gives NULL."""
    c = _col(c)
    text = F.concat(
        F.lit(century), F.substring(c, 1, 2), F.lit("-"), F.substring(c, 3, 2), F.lit("-"),
        F.substring(c, 5, 2), F.substring(c, 7, 9),
    )
    return F.when(c.rlike(r"^\d{6} \d{2}:\d{2}:\d{2}$"), text.try_cast("timestamp_ntz"))
