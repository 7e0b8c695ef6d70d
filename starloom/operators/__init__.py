"""Frame-to-frame building blocks."""

from starloom.operators.checks import (
    LoadGateError,
    Reference,
    broken_references,
    check_rules,
    counts_match,
    orphan_count,
    pass_fail,
    require,
    require_unique,
    row_count_sheet,
    totals_match,
)
from starloom.operators.dedup import latest_per_key, preferred_per_key
from starloom.operators.joins import fits_broadcast, lookup_join
from starloom.operators.keys import assign_keys, max_key
from starloom.operators.lookup import DayLookup, KeyLookup, days_of, resolve_keys, resolve_once, unmatched_rows
from starloom.operators.profile import (
    control_totals,
    count_where,
    duplicate_keys,
    missing_profile,
    value_frequency,
)
from starloom.operators.upsert import (
    ACTION,
    action_counts,
    as_current,
    ensure_unknown,
    insert_new,
    new_rows,
    new_rows_by_key,
    update_matched,
    upsert,
    upsert_current,
)

__all__ = [
    "ACTION", "DayLookup", "KeyLookup", "LoadGateError", "Reference", "action_counts", "as_current", "assign_keys",
    "broken_references", "check_rules", "control_totals", "count_where", "counts_match", "days_of",
    "duplicate_keys", "ensure_unknown", "fits_broadcast", "insert_new", "latest_per_key",
    "lookup_join", "max_key", "missing_profile", "new_rows", "new_rows_by_key", "orphan_count", "pass_fail",
    "preferred_per_key", "require", "require_unique", "resolve_keys", "resolve_once",
    "row_count_sheet", "totals_match", "unmatched_rows", "update_matched", "upsert", "upsert_current",
    "value_frequency",
]
