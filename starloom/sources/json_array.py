"""Large JSON documents, each one array of objects, read by many tasks.

The text reader cuts a file at every ``}`` and gives the pieces to tasks by file
block.  Which of these braces end an object of the array, and not a nested one or a
character of a string, follows from what comes before: whether a string is open,
and how deep the braces are.  Both are sums, so each block is summed up for itself,
once as if a string was open at its start and once as if none was; adding up
the blocks of a file then tells how each really starts.  After that every piece
knows the number of its object, and only objects of several pieces, nested ones and
those on a border of blocks, are put together by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import stage_table

_BLOCK = ["file", "block"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, block, n, value, quotes, opens0, opens1): pieces in order of n within their block.

    ``quotes`` counts the quotes that are not escaped; ``opens0`` the braces
    opened outside of strings if none is open before the piece, ``opens1`` if one is.
    """
    read = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), "value")
    # an escape is a backslash and what follows it, which a cut at a brace never parts
    parts = read.withColumn("part", F.split(F.regexp_replace("value", r"\\.", ""), '"', -1))
    opens = "aggregate(filter(part, (x, i) -> i % 2 = {}), 0L, (n, x) -> n + length(x) - length(replace(x, '{{', '')))"
    return parts.selectExpr(
        "file", "size", "block", "n", "value", "CAST(size(part) - 1 AS BIGINT) AS quotes",
        f"{opens.format(0)} AS opens0", f"{opens.format(1)} AS opens1")


def _within(pieces: DataFrame, start: str, depth: str) -> DataFrame:
    """``before`` and ``after``, the depth around each piece, if its block starts so; ``open``: whether its brace is in a string."""
    earlier = Window.partitionBy(*_BLOCK).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    state = F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) + F.expr(start), F.lit(2))
    return (
        pieces.withColumn("state", state)
        .withColumn("open", F.pmod(F.col("state") + F.col("quotes"), F.lit(2)))
        .withColumn("change", F.expr("IF(state = 0, opens0, opens1) - IF(open = 0, 1, 0)"))
        .withColumn("before", F.coalesce(F.sum("change").over(earlier), F.lit(0)) + F.expr(depth))
        .withColumn("after", F.col("before") + F.col("change"))
    )


def _block_starts(pieces: DataFrame) -> DataFrame:
    """(file, block, start, depth): how each block starts; and how its file ends, (last_open, last_depth, rest).

    ``rest`` is 1 if something follows the last brace, else 0.
    """
    as_if = [
        _within(pieces, str(s), "0").groupBy(*_BLOCK).agg(
            F.sum("change").alias(f"change{s}"), F.sum("quotes").alias(f"quotes{s}"), F.max("size").alias(f"size{s}"),
            F.sum(F.octet_length("value") + 1).alias(f"bytes{s}")) for s in (0, 1)
    ]
    blocks = as_if[0].join(as_if[1], _BLOCK)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    # a file has a row per block here
    return (
        blocks.withColumn("start", F.pmod(F.coalesce(F.sum("quotes0").over(earlier), F.lit(0)), F.lit(2)))
        .withColumn("change", F.expr("IF(start = 0, change0, change1)"))
        .withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
        .withColumn("last_open", F.pmod(F.sum("quotes0").over(whole), F.lit(2)))
        .withColumn("last_depth", F.sum("change").over(whole))
        .withColumn("rest", F.sum("bytes0").over(whole) - F.col("size0"))
        .select(*_BLOCK, "start", "depth", "last_open", "last_depth", "rest")
    )


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The objects of files that each hold one array of objects or one object; None if the braces do not add up."""
    pieces = stage_table(_pieces(spark, path), "json_pieces")
    starts = stage_table(_block_starts(pieces), "json_blocks")
    # what follows the last brace of an array is counted as if it ended with one more
    if not starts.where("last_open <> 0 OR last_depth <> -rest").isEmpty():
        return None
    starts = starts.select(*_BLOCK, "start", "depth")
    placed = _within(pieces.join(F.broadcast(starts), _BLOCK), "start", "depth").withColumn(
        "ends", F.expr("IF(open = 0 AND after = 0, 1, 0)"))
    placed = stage_table(placed.select(*_BLOCK, "n", "value", "before", "open", "after", "ends"), "json_places")
    if not placed.where("after < -1 OR before < 0").isEmpty():
        return None
    earlier = Window.partitionBy(*_BLOCK).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    ended = placed.groupBy(*_BLOCK).agg(F.sum("ends").alias("ends"))
    sooner = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = ended.select(*_BLOCK, F.coalesce(F.sum("ends").over(sooner), F.lit(0)).alias("base"))
    numbered = (
        placed.withColumn("number", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
        .join(F.broadcast(base), _BLOCK).withColumn("number", F.col("number") + F.col("base"))
        .where("after >= 0")
    )
    single = "before = 0 AND ends = 1"
    whole = numbered.where(single).select(F.concat("value", F.lit("}")).alias("value"))
    joined = (
        numbered.where(f"NOT ({single})").groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("pieces"))
        .select(F.concat(F.array_join("pieces.value", "}"), F.lit("}")).alias("value"))
    )
    record = F.from_json(F.regexp_replace("value", r"^[^{]*", ""), schema).alias("record")
    return whole.unionByName(joined).select(record).select("record.*")
