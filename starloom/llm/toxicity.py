"""Toxicity severity by cumulative-link ordinal regression.

Texts are lower-cased; words are runs of digits, a-z and characters beyond
ASCII.  A feature is a word or its first 4, 5 or 6 bytes; its value is
log(1 + occurrences per ``PER_WORDS`` words of the text), as a grade tells of shares
of words, too.  One weight per feature serves all ordered thresholds:
P(grade >= k) = sigmoid(w x - t_k) with t_1 < t_2 < ...  A document's severity is
the expected grade; it is toxic if P(grade >= 1) is at least one half.

Learning reads whole texts of a bounded sample: up to ``SAMPLE`` toxic and as
many other labelled documents, those with the smallest hash of their id.  Of several
rows of an id, the text with the smallest hash counts.
Features are those whose share of documents differs between the two by more
than ``LEAST_Z`` standard errors, the ``FEATURES`` strongest.  Both kinds weigh
the same altogether.  Labels give only
toxic or not; a toxic document's grade, from 1 to ``GRADES``, tells in which part of the
toxic ones it is by the share of its words that are marked by a feature of
toxic documents, so a long document is not of a higher grade for its length alone.

Null and empty texts have no features.  Of contradicting labels of one document
toxic wins; null labels are none.  Without labels of both kinds there is no
feature, and nothing is toxic.  Repeated rows give a row each; an empty table
gives none; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.arrow import WORD_BYTES, among, buffers, Hashes, send_code, slices, strings, words
from starloom.session import stage_table

#: Labelled documents of each kind that are learned from, at most.
SAMPLE = 5_000

#: Features kept, at most.
FEATURES = 5_000

LEAST_Z = 4.5

#: Documents that must hold a feature.
LEAST_DOCS = 4

#: Grades of toxic documents, of equal numbers of them.
GRADES = 3

PREFIXES = (4, 5, 6)

#: Words to which occurrences are scaled.
PER_WORDS = 1_000


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, feature) of every word and prefix; the word is numbered."""
    data, at = buffers(pc.utf8_lower(texts))
    begin, end, first = words(data, at, WORD_BYTES)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    hashes, number = Hashes(data), np.arange(len(begin))
    rows, numbers, found = [row], [number], [hashes.of(begin, end)]
    for size in PREFIXES:
        long = end - begin >= size
        rows.append(row[long])
        numbers.append(number[long])
        # a prefix is told from an equal word
        found.append(hashes.of(begin[long], begin[long] + size) ^ np.uint64(size))
    return np.concatenate(rows), np.concatenate(numbers), np.concatenate(found)


def _word_counts(row: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    """Words of each of ``n`` texts, from their features, which begin with the words themselves."""
    return np.bincount(row[: number.max(initial=-1) + 1], minlength=n)


def _values(
    texts: pa.Array, vocabulary: np.ndarray, per_words: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the vocabulary, value) of the known features; occurrences count per so many words, if given."""
    row, number, found = features(texts)
    known = among(found, vocabulary)
    place = np.searchsorted(vocabulary, found[known])
    pairs, n = np.unique(row[known] * max(len(vocabulary), 1) + place, return_counts=True)
    size = max(len(vocabulary), 1)
    if per_words is not None:
        n = per_words * n / _word_counts(row, number, len(texts))[pairs // size]
    return pairs // size, pairs % size, np.log1p(n)


@dataclass
class Ordinal:
    """Weights of the vocabulary (sorted hashes), the ordered thresholds, and the words occurrences are scaled to, if any."""

    vocabulary: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    per_words: int | None = None

    def at_least(self, row: np.ndarray, place: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """[text, k]: probability of grade k + 1 or more."""
        score = np.bincount(row, self.weights[place] * value, n)
        return _sigmoid(score[:, None] - self.thresholds)

    def predict(self, texts: pa.Array) -> np.ndarray:
        return self.at_least(*_values(texts, self.vocabulary, self.per_words), len(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, size: int, grades: int,
        steps: int = 400, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that make the grades most likely; gradient steps with momentum."""
    n, each = len(grade), np.arange(len(grade))
    # toxic documents and others weigh the same altogether, however many there are
    toxic = grade > 0
    weight = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    # thresholds as a first one and the logarithms of the gaps, so they stay in order
    param = np.concatenate([np.zeros(size), [0.0], np.full(grades - 2, 0.0)])
    mean, square = np.zeros(len(param)), np.zeros(len(param))
    for step in range(1, steps + 1):
        w, first, gaps = param[:size], param[size], np.exp(param[size + 1 :])
        thresholds = first + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(row, w[place] * value, n)
        above = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - thresholds), np.zeros((n, 1))], 1)
        slope = above * (1 - above)
        likely = np.maximum(above[each, grade] - above[each, grade + 1], 1e-12)
        d_low, d_high = -slope[each, grade] / likely * weight, slope[each, grade + 1] / likely * weight
        d_score = d_low + d_high
        d_threshold = np.zeros(grades + 1)
        np.add.at(d_threshold, grade, -d_low)
        np.add.at(d_threshold, grade + 1, -d_high)
        d_threshold = d_threshold[1:grades]
        d_gap = np.cumsum(d_threshold[::-1])[::-1][1:] * gaps
        slope = np.concatenate([
            np.bincount(place, d_score[row] * value, size) + ridge * w, [d_threshold.sum()], d_gap
        ])
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))
        param -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    gaps = np.exp(param[size + 1 :])
    return param[:size], param[size] + np.concatenate(([0.0], np.cumsum(gaps)))


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(toxic, text, id) of the documents learned from, a row each."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("_llm_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("_llm_id IS NOT NULL AND toxic IS NOT NULL").groupBy("_llm_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    counts = known.groupBy("toxic").count().collect()
    if not counts:
        return docs.select(
            F.lit(0).alias("toxic"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("id")).limit(0)
    # about twice the sample lies below this share of the hashes, so the sort sees no more
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["toxic"], min(1.0, 2 * sample / r["count"]))])
    by = Window.partitionBy("toxic").orderBy("h", "_llm_id")
    chosen = (
        known.withColumn("h", F.shiftrightunsigned(F.xxhash64("_llm_id"), 1))
        .where(F.col("h") / F.lit(float(1 << 63)) <= F.element_at(share, F.col("toxic")))
        .withColumn("n", F.row_number().over(by)).where(F.col("n") <= sample).select("_llm_id", "toxic")
    )
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a null text, which teaches nothing, only if the id has no other
    order = F.struct(F.col("text").isNull().alias("none"), F.xxhash64("text").alias("h"), F.col("text").alias("text"))
    return (
        plain.join(F.broadcast(chosen), F.col("doc_id") == F.col("_llm_id")).groupBy("_llm_id", "toxic")
        .agg(F.min(order).alias("least")).select("toxic", F.col("least.text").alias("text"), F.col("_llm_id").alias("id"))
    )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """Weights and thresholds from labelled documents; see the module for the sample."""
    send_code(docs.sparkSession)
    grades = GRADES + 1
    nothing = Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.full(grades - 1, 40.0))
    chosen = stage_table(_sample(docs, labels, sample), "examples")

    def count(batches):
        for batch in batches:
            toxic, texts = batch.column(0).to_numpy(), strings(batch.column(1))
            for a, b in slices(texts):
                row, _, found = features(texts[a:b])
                order = np.lexsort((row, found))
                row, found = row[order], found[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                known, inverse = np.unique(found[new], return_inverse=True)
                bad = np.bincount(inverse, toxic[a:b][row[new]], len(known)).astype(np.int64)
                total = np.bincount(inverse, minlength=len(known))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known.view(np.int64)), pa.array(bad), pa.array(total - bad)], ["feature", "bad", "good"])

    n = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return nothing
    bad, good, both = F.col("bad") / n[1], F.col("good") / n[0], (F.col("bad") + F.col("good")) / (n[0] + n[1])
    error = F.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]) + 1e-12)
    table = (
        chosen.mapInArrow(count, "feature long, bad long, good long")
        .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(F.col("bad") + F.col("good") >= LEAST_DOCS)
        .withColumn("z", (bad - good) / error).where(F.abs("z") >= LEAST_Z)
        .orderBy(F.desc(F.abs("z")), "feature").limit(FEATURES).select("feature", "z", "bad", "good").toArrow()
    )
    if not table.num_rows:
        return nothing
    vocabulary = table.column("feature").to_numpy().view(np.uint64)
    by = np.argsort(vocabulary)
    vocabulary = vocabulary[by]
    # a marker is rarely in other documents
    share = table.column("bad").to_numpy() / n[1], table.column("good").to_numpy() / n[0]
    marker = (share[0] > 20 * share[1])[by]
    markers = vocabulary[marker]

    def examples(batches):
        for batch in batches:
            toxic, texts, ids = batch.column(0), strings(batch.column(1)), batch.column(2)
            for a, b in slices(texts):
                row, place, value = _values(texts[a:b], vocabulary, PER_WORDS)
                cuts = np.searchsorted(row, np.arange(b - a + 1))
                at, number, found = features(texts[a:b])
                known = among(found, markers)
                marked = np.bincount(at[known][np.unique(number[known], return_index=True)[1]], minlength=b - a)
                n_words = _word_counts(at, number, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[a:b], toxic[a:b], pa.array(marked / np.maximum(n_words, 1)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(place.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(value.astype(np.float32))),
                    ],
                    ["id", "toxic", "marked", "place", "value"],
                )

    seen = chosen.mapInArrow(examples, "id long, toxic int, marked double, place array<int>, value array<float>").toArrow()
    seen = seen.sort_by("id")  # sums of floats in one order
    toxic, marked = seen.column("toxic").to_numpy(), seen.column("marked").to_numpy()
    grade = grades_of(toxic, marked)
    size = pc.list_value_length(seen.column("place")).to_numpy()
    row = np.repeat(np.arange(len(grade)), size)
    place = pc.list_flatten(seen.column("place")).to_numpy().astype(np.int64)
    value = pc.list_flatten(seen.column("value")).to_numpy().astype(np.float64)
    return Ordinal(vocabulary, *fit(row, place, value, grade, len(vocabulary), grades), PER_WORDS)


def grades_of(toxic: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """0 for documents that are not toxic; the others are cut into ``GRADES`` equal parts by their share of marked words."""
    cuts = np.quantile(marked[toxic > 0], np.arange(1, GRADES) / GRADES)
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, marked, "left"), 0)


def severity(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, severity (expected grade), grade (the largest that is likelier than not), toxic."""
    send_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                above = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(above.sum(1)),
                     pa.array((above >= 0.5).sum(1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                    ["doc_id", "severity", "grade", "toxic"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(task, "doc_id long, severity double, grade int, toxic boolean")


def civil(docs: DataFrame, model: Ordinal) -> DataFrame:
    """The documents that are not toxic, with all columns."""
    send_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(column))
            for a, b in slices(texts):
                above = shared.value.predict(texts[a:b])
                yield batch.slice(a, b - a).filter(pa.array(above[:, 0] < 0.5))

    return docs.mapInArrow(task, docs.schema)
