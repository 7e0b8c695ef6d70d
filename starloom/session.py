"""Session settings and the shared scratch area.

Stage results are written as Parquet under the folder the cluster names in
``spark.checkpoint.dir``.  A written table cuts lineage, survives the loss of
executors, and is columnar, so later stages read only the columns they need.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def sized_for(input_bytes: int) -> dict[str, str]:
    """Partition settings for a load of this many bytes.

    Shuffles start at about 128 MB a partition, which a task sorts in memory;
    AQE joins those that turn out small.  Scans of very large inputs use larger
    splits, to keep the number of tasks in the hundred thousands.
    """
    mb = 1024 * 1024
    partitions = min(max(-(-input_bytes // (128 * mb)), 8), 200_000)
    split = 128 if input_bytes < 10 * mb * mb else 512
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    }


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    Skewed shuffle partitions are split at run time by AQE; ``conf`` entries
    override or add settings (pass dotted names through a dict: ``**{...}``;
    ``**sized_for(bytes)`` sets the partition sizes).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables.

    Taken from the session.  One that names none uses its warehouse, which every
    executor can reach as well; what is written there goes when the session ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/starloom-{context.applicationId}"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


_RUN: ContextVar[str | None] = ContextVar("starloom_run", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Stage tables written inside lie in one folder, which is removed at the end.

    What is to outlive the run must be published elsewhere.
    """
    path = f"{work_dir(spark)}/starloom/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the folder of the run or the shared folder."""
    return f"{_RUN.get() or work_dir(spark) + '/starloom'}/{uuid.uuid4().hex}/{name}"


def byte_size(df: DataFrame) -> Column:
    """Aggregate: about how many bytes the rows take, by the lengths of their texts."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in texts]
    return reduce(add, lengths, F.count(F.lit(1)) * (16 * len(df.columns)))


_SIZE = "_starloom_size"


def known_size(df: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes) of a stage table or a part of one, as counted when it was written."""
    return getattr(df, _SIZE, None)


def part_of(whole: DataFrame, part: DataFrame) -> DataFrame:
    """``part``, some rows or columns of ``whole``, with the whole's size as its bound."""
    if known_size(whole) is not None:
        setattr(part, _SIZE, known_size(whole))
    return part


_ONE_PER = "_starloom_one_per"


def one_per(df: DataFrame, key: str) -> DataFrame:
    """``df``, noted to have one row for each value of ``key`` and none without one; by what made it so."""
    setattr(df, _ONE_PER, key)
    return df


def is_one_per(df: DataFrame, key: str) -> bool:
    """Whether ``df`` is noted to have one row for each value of ``key``."""
    return getattr(df, _ONE_PER, None) == key


def rows_of(whole: DataFrame, part: DataFrame) -> DataFrame:
    """``part``, some rows of ``whole`` with the column they are unique by, noted like it."""
    if getattr(whole, _ONE_PER, None) is not None:
        one_per(part, getattr(whole, _ONE_PER))
    return part


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table.

    Rows and bytes are counted by the write itself; see ``known_size``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), byte_size(df).alias("bytes")).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    setattr(stored, _SIZE, (seen.get["rows"], seen.get["bytes"]))
    return rows_of(df, stored)


def local_rows(spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType) -> DataFrame:
    """A few rows as part of the plan, so reading them starts no job."""
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    kinds = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
    df = spark.createDataFrame(table, schema)
    setattr(df, _SIZE, (len(rows), table.nbytes))
    return df
