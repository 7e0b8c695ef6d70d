"""Exact top-k search by inner product with MaxScore.

A component x counts as floor(1024 x); the score of two vectors is the inner
product of these integers, components that one of them lacks being 0.  Vectors
are dealt to shards by a hash of their id.  A shard keeps two posting lists for
each component: vectors where it is positive, and where it is negative, with
the largest value on each side.

For a query, a list whose sign is that of the query's component can raise a
score by at most its bound; the other list can only lower it.  The smallest
bounds that together stay below the k-th best score known are non-essential: a
vector in no other list cannot be among the best.  The essential lists are
traversed and summed, then the remaining components are probed by falling
bound for the vectors that can still reach the k-th best score.  The first
value of that score comes from the vectors that head the strongest lists.

Each shard gives each query at most k results, which are merged.  All queries
meet every shard, one shard after the other in a stream of rows, so a task
holds one shard and a batch of queries.

A score beyond a long counts as the largest or the smallest long, so such
scores tie.  Vectors that are null, or hold a null, NaN or infinite component, and rows
without an id take no part.  An empty vector scores 0.  Rows with one id count
as one, that with the smallest vector.  Ties go to the smaller id.  An empty
table gives nothing; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code

SCALE = 1024

#: Vectors of a shard: at most, and the fewest for which it is worth having more shards.
SHARD_ROWS = 65_536
LEAST_ROWS = 1_024

#: Shards that are made anyway if there are vectors enough, to use the cluster.
LEAST_SHARDS = 48

#: Bytes that the components of a shard take at most, all vectors being as long as the longest.
SHARD_BYTES = 256 << 20

#: The range of a score.
LEAST, MOST = -(1 << 63), (1 << 63) - 1

#: Vectors at the head of a list that give the first k-th best score.
HEAD = 8


def _integers(vectors: pa.Array) -> list[np.ndarray]:
    at = np.asarray(vectors.offsets)
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(SCALE * flat)
    exact = np.abs(whole).max(initial=0) < 2.0**62
    whole = whole.astype(np.int64) if exact else np.array([int(x) for x in whole.tolist()], object)
    return [whole[a:b] for a, b in zip(at[:-1], at[1:])]


class Shard:
    """Posting lists of some vectors; ``ids`` ascend."""

    def __init__(self, ids: list[int], vectors: list[np.ndarray]):
        self.ids = np.array(ids, np.int64)
        width = max((len(v) for v in vectors), default=0)
        kind = object if any(v.dtype == object for v in vectors) else np.int64
        self.columns = np.zeros((width, len(ids)), kind)
        for i, v in enumerate(vectors):
            self.columns[: len(v), i] = v
        self.largest = int(np.abs(self.columns).max(initial=0))
        self.lists = []
        for column in self.columns:
            both = []
            for sign in (1, -1):
                rows = np.flatnonzero(column * sign > 0)
                heads = rows[np.argsort(-(column[rows] * sign).astype(np.float64), kind="stable")[:HEAD]]
                both.append((rows, column[rows], int(np.abs(column[rows]).max(initial=0)), heads))
            self.lists.append(both)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k other vectors, at least; all that tie with the last are given."""
        n = len(self.ids)
        width = min(len(query), len(self.columns))
        columns = self.columns
        if self.largest * int(np.abs(query).max(initial=0)) * max(width, 1) >= 1 << 62:
            columns, query = columns.astype(object), query.astype(object)
        skip = int(np.searchsorted(self.ids, own))
        skip = skip if skip < n and self.ids[skip] == own else -1
        terms = []  # bound, component, list
        for t in range(width):
            if query[t]:
                rows, values, largest, heads = self.lists[t][0 if query[t] > 0 else 1]
                terms.append((abs(int(query[t])) * largest, t, rows, values, heads))
        terms.sort(key=lambda x: (-x[0], x[1]))
        # the k-th best of a few promising vectors is a lower bound of the k-th best of all
        floor = None
        if terms:
            some = np.unique(np.concatenate([x[4] for x in terms[: max(4, k)]]))
            some = some[some != skip]
            if len(some) >= k:
                scores = self._scores(columns, query, width, some)
                floor = np.sort(scores)[len(scores) - k]
                # beyond the range of a score all are equal
                floor = None if floor <= LEAST else min(floor, MOST)
        rest, essential = 0, len(terms)
        while essential and floor is not None and rest + terms[essential - 1][0] < floor:
            essential -= 1
            rest += terms[essential][0]
        total = np.zeros(n, columns.dtype)
        for _, t, rows, values, _ in terms[:essential]:
            total[rows] += query[t] * values
        if floor is None:
            left = np.arange(n)
        else:
            # with rest < floor, a vector in no essential list is out
            left = np.flatnonzero(total + rest >= floor)
        left = left[left != skip]
        total = total[left]
        # what lowers the score of an essential component was not in its list
        for _, t, _, _, _ in terms[:essential]:
            value = query[t] * columns[t, left]
            total = total + np.minimum(value, 0)
            if floor is not None and len(left) > 4 * k:
                keep = total + rest >= floor
                left, total = left[keep], total[keep]
        for bound, t, _, _, _ in terms[essential:]:
            total = total + query[t] * columns[t, left]
            rest -= bound
            keep = total + rest >= floor
            left, total = left[keep], total[keep]
        if total.dtype == object:
            total = np.array([min(max(x, LEAST), MOST) for x in total.tolist()], object)
        if len(left) > k:
            last = np.sort(total)[len(total) - k]
            left, total = left[total >= last], total[total >= last]
        return self.ids[left], total

    def _scores(self, columns, query, width, rows) -> np.ndarray:
        total = np.zeros(len(rows), columns.dtype)
        for t in range(width):
            total = total + query[t] * columns[t, rows]
        return total


def _valid(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shards: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best vectors of each query, its own left out.

    Both tables have ``vec_id`` and ``embedding``.
    """
    send_code(vectors.sparkSession)
    vectors, queries = _valid(vectors), _valid(queries)
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    shards = shards or max(1, min(n // LEAST_ROWS, LEAST_SHARDS), -(-n // SHARD_ROWS), -(-n * width * 8 // SHARD_BYTES))
    stream = (
        vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                       F.lit(0).alias("kind"), "vec_id", "embedding")
        .unionByName(queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                                    F.lit(1).alias("kind"), "vec_id", "embedding"))
        .repartition(shards, "shard").sortWithinPartitions("shard", "kind", "vec_id", "embedding")
    )

    def task(batches):
        at, ids, rows, shard, asked = None, [], [], None, None
        for batch in batches:
            numbers, kinds, names = (batch.column(i).to_pylist() for i in range(3))
            vectors = _integers(batch.column(3))
            found = []
            for number, kind, name, vector in zip(numbers, kinds, names, vectors):
                if number != at:
                    at, ids, rows, shard, asked = number, [], [], None, None
                if kind == 0:
                    if not ids or ids[-1] != name:
                        ids.append(name)
                        rows.append(vector)
                    continue
                if shard is None:
                    shard = Shard(ids, rows)
                    rows = []
                if asked == name:
                    continue
                asked = name
                best, scores = shard.search(vector, name, k)
                order = np.lexsort((best, [-s for s in scores.tolist()]))[:k]
                found += [(name, int(best[i]), int(scores[i])) for i in order]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*found)], ["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        stream.mapInArrow(task, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
