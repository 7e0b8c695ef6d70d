"""Text and code standardising."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.constants import UNKNOWN_CODE, UNKNOWN_TEXT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for NULL and for text made of blanks only."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def norm_code(c: Column | str, default: str = UNKNOWN_CODE) -> Column:
    """Upper-cased, trimmed code; NULL or blank becomes ``default``."""
    return F.coalesce(F.nullif(F.upper(F.trim(_col(c))), F.lit("")), F.lit(default))


def clean_text(c: Column | str, default: str = UNKNOWN_TEXT) -> Column:
    """Trimmed text; NULL or blank becomes ``default``."""
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(default))


def map_code(
    c: Column | str,
    mapping: Mapping[str, object],
    else_: object = None,
    keep_others: bool = False,
) -> Column:
    """Translate a code after normalising it.

    Codes outside ``mapping`` become ``else_``, or, with ``keep_others``, pass
    through in their normalised form.  The mapping is a short constant, so it is
    a literal map rather than a join, and the code is normalised once.
    """
    code = norm_code(c)
    fallback = code if keep_others else F.lit(else_)
    if not mapping:
        return fallback
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), fallback)
