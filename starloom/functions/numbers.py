"""Fixed-point money, tolerant conversion, zero-safe ratios, conditional measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.constants import INFLOW_TYPES, OUTFLOW_TYPES
from starloom.functions.codes import _col, norm_code


def money(c: Column | str) -> Column:
    return _col(c).cast("decimal(18,2)")


def total(c: Column | str) -> Column:
    """Sum of a money column, wide enough for any number of rows."""
    return F.sum(_col(c)).cast("decimal(38,2)")


def whole(c: Column | str) -> Column:
    """Nearest integer, halves away from zero."""
    return F.round(_col(c), 0).cast("int")


def _numeric_text(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def try_int(c: Column | str) -> Column:
    """Integer, or NULL when the text is not one."""
    return _numeric_text(c).try_cast("int")


def try_money(c: Column | str) -> Column:
    return _numeric_text(c).try_cast("decimal(18,2)")


def try_rate(c: Column | str) -> Column:
    return _numeric_text(c).try_cast("decimal(5,2)")


def first_number(convert, *columns: Column | str) -> Column:
    """First column that converts, e.g. this year's figure, else last year's."""
    return F.coalesce(*[convert(c) for c in columns])


def ratio(numerator: Column, denominator: Column, kind: str = "decimal(18,2)") -> Column:
    """``numerator / denominator`` at a fixed scale; NULL when the denominator is 0.

    The numerator is held at 28 digits, which leaves the quotient 12 decimals,
    so rounding it to ``kind`` is not rounding a rounded number.
    """
    quotient = numerator.cast("decimal(28,2)") / F.nullif(denominator, F.lit(0).cast("bigint"))
    return quotient.cast(kind)


def inflow(type_: Column | str, amount: Column | str) -> Column:
    return money(F.when(norm_code(type_).isin(INFLOW_TYPES), _col(amount)).otherwise(F.lit(0)))


def outflow(type_: Column | str, amount: Column | str) -> Column:
    return money(F.when(norm_code(type_).isin(OUTFLOW_TYPES), _col(amount)).otherwise(F.lit(0)))


def signed(type_: Column | str, amount: Column | str) -> Column:
    code, value = norm_code(type_), _col(amount)
    return money(
        F.when(code.isin(INFLOW_TYPES), value)
        .when(code.isin(OUTFLOW_TYPES), -value)
        .otherwise(F.lit(0))
    )
