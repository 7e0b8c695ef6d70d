"""starloom: dimensional-warehouse building blocks on Spark DataFrames.

The package is layered the way a load runs:

* ``functions``  column expressions (code normalising, dates, money)
* ``sources``    readers, staging, snapshot publishing
* ``operators``  frame-to-frame building blocks (dedup, lookups, keys, upsert, checks)
* ``plans``      the named jobs: clean tables, dimensions, facts, marts, validation
* ``streaming``  incremental delivery of the fact append
"""

from starloom.session import build_session, sized_for, stage_table

__all__ = ["build_session", "sized_for", "stage_table"]
