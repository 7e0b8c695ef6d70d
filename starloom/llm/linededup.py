"""Lines that several documents share, kept in one of them.

A text is cut at every line feed; a null or empty one is a single empty line.  A
line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z as
a-z.  Keys of at least ``min_chars`` code points are hashed to 128 bits and the
different documents of each hash are counted.  Where there are at least
``min_docs``, all lines with the key go, except in the document with the
smallest id.  What is left is put together again by position.

Lines travel as hashes: one row of fixed width for each line, written once.  Texts
move only to meet the positions they lose.  Distinct (key, document) pairs are
counted, so a key in every document is added up in the tasks; when lines look up
their key, the keys that hold over a ``1 / HOT_KEYS`` part of all lines, which are
no more than that many, are broadcast and their lines stay where they are.

Rows without an id count as one document that comes after all others.  Rows of
one id are one document: a line they share is not shared by that alone, and
each row gets a result.  An empty table gives none.  Further columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code, slices, strings
from starloom.session import stage_table

SPACE = b" \t\n\x0b\x0c\r"

#: Keys that can hold more than this part of the lines are fewer than this many.
HOT_KEYS = 1_000


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """What a UTF-8 line is compared by; None if it is too short to be compared."""
    key = line.strip(SPACE).lower()
    # a code point has four bytes at most, so long keys need no count
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes of the text; with the id they tell a row, and equal rows have one fate."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def _line_table(named: DataFrame, min_chars: int) -> DataFrame:
    """(key, doc_id, t1, t2, line): the compared lines of every row by number."""

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                keys, rows, numbers = [], [], []
                for row, text in enumerate(texts[a:b].cast(pa.large_binary()).to_pylist(), a):
                    for number, line in enumerate(text.split(b"\n")):
                        key = line_key(line, min_chars)
                        if key is not None:
                            keys.append(xxhash.xxh3_128_digest(key))
                            rows.append(row)
                            numbers.append(number)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), *(batch.column(c).take(at) for c in (0, 2, 3)),
                     pa.array(numbers, pa.int32())],
                    ["key", "doc_id", "t1", "t2", "line"],
                )

    return named.mapInArrow(task, "key binary, doc_id long, t1 long, t2 long, line int")


def _lost_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, t1, t2, lost): the numbers of the lines each row loses, in no order."""
    shared = stage_table(
        lines.select("key", "doc_id").distinct()
        .groupBy("key").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first"))
        .where(F.col("n_docs") >= min_docs),
        "line_keys",
    )
    total = lines.count()
    many = lines.groupBy("key").count().where(F.col("count") * HOT_KEYS > total).select("key")
    few = stage_table(shared.join(F.broadcast(many), "key", "left_semi").select("key", "first"), "line_hot_keys")
    hot = lines.join(F.broadcast(few), "key")
    rest = lines.join(F.broadcast(few), "key", "left_anti").join(shared.select("key", "first"), "key")
    return (
        hot.unionByName(rest).where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "t1", "t2").agg(F.collect_set("line").alias("lost"))
    )


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """doc_id, text (the lines kept, joined by a line feed), n_lines (before), n_dropped; a row for each of ``docs``."""
    send_code(docs.sparkSession)
    named = _named(docs)
    lost = _lost_lines(stage_table(_line_table(named, min_chars), "lines"), min_docs)
    # the lists of lost lines are the side a task holds; texts stream past them and are not sorted
    both = named.alias("d").join(
        lost.hint("shuffle_hash").alias("l"),
        F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.t1") == F.col("l.t1")) & (F.col("d.t2") == F.col("l.t2")),
        "left",
    ).select("d.doc_id", "d.text", "l.lost")

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                kept, n_lines, n_dropped = [], [], []
                for text, lost in zip(texts[a:b].cast(pa.large_binary()).to_pylist(),
                                      batch.column(2).slice(a, b - a).to_pylist()):
                    if lost:
                        gone, all_lines = set(lost), text.split(b"\n")
                        n_lines.append(len(all_lines))
                        text = b"\n".join([x for i, x in enumerate(all_lines) if i not in gone])
                    else:
                        n_lines.append(text.count(b"\n") + 1)
                    n_dropped.append(len(lost or ()))
                    kept.append(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(kept, pa.binary()).cast(pa.string()),
                     pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    ["doc_id", "text", "n_lines", "n_dropped"],
                )

    return both.mapInArrow(task, "doc_id long, text string, n_lines long, n_dropped long")
