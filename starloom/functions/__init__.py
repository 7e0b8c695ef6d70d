"""Column expressions; everything here stays inside whole-stage codegen."""

from starloom.functions.codes import clean_text, is_blank, map_code, norm_code
from starloom.functions.dates import (
    age_band,
    century_timestamp,
    date_key,
    year_diff,
    year_month_label,
)
from starloom.functions.numbers import (
    first_number,
    inflow,
    money,
    outflow,
    ratio,
    signed,
    total,
    try_int,
    try_money,
    try_rate,
    whole,
)

__all__ = [
    "age_band", "century_timestamp", "clean_text", "date_key", "first_number", "inflow",
    "is_blank", "map_code", "money", "norm_code", "outflow", "ratio", "signed", "total",
    "try_int", "try_money", "try_rate", "whole", "year_diff", "year_month_label",
]
