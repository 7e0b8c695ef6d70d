"""Full extract into the staging layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDIT = "ETL_LoadDateTime"


def with_audit(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Stamp every row with the time of the run, one literal for all rows."""
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumn(AUDIT, stamp)


def extract(source: DataFrame, path: str, run_ts: dt.datetime) -> DataFrame:
    """Replace the staged copy at ``path`` with all rows of ``source``."""
    staged = with_audit(source, run_ts)
    staged.write.mode("overwrite").parquet(path)
    return source.sparkSession.read.schema(staged.schema).parquet(path)
