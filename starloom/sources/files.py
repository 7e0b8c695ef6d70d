"""File sources with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import DISTRICT_FILE, DISTRICT_NAMES
from starloom.session import local_rows
from starloom.sources.json_array import read_json_array


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ";",
    missing: str = "?",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Delimited text with a header, quoted strings and a missing-value mark.

    A value that does not fit its declared type stops the read; declare the
    column as text and convert it with ``try_int`` and friends to let it pass.
    """
    return spark.read.schema(schema).csv(
        path, sep=sep, header=True, quote='"', nullValue=missing, mode=mode
    )


def read_district_file(spark: SparkSession, path: str) -> DataFrame:
    """The raw district file under the names the rest of the load uses."""
    raw = read_delimited(spark, path, DISTRICT_FILE)
    return raw.select(*[F.col(a).alias(name) for a, name in DISTRICT_NAMES.items()])


#: files of one array beyond this size are read by several tasks
SPLIT_BYTES = 64 << 20


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, document: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """JSON records.

    By default one record per line, which splits into tasks.  ``document``
    reads files that each hold one array of records, or one single record.
    Small files are a task each; where one is larger than ``split_bytes``, the files
    are cut at their braces.  If these do not add up in some file, all are read as whole documents.
    """
    if document:
        # only the lengths are read
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
        if largest is not None and largest > split_bytes:
            found = read_json_array(spark, path, schema)
            if found is not None:
                return found
    return spark.read.schema(schema).json(path, multiLine=document)


def convert(df: DataFrame, path: str, kind: str = "json", **options: object) -> str:
    """Write ``df`` in another file format (json = one record per line)."""
    df.write.mode("overwrite").format(kind).options(**options).save(path)
    return path


def constant_table(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A short table of fixed rows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return local_rows(spark, rows, schema)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, for a look at the data; which ones is not defined."""
    return df.limit(n)
