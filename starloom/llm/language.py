"""Language ID by prediction with partial matching.

Each language has a tree of byte contexts of up to ``order`` bytes, built from
lower-cased texts of known language.  A context that was followed n times by d
different bytes gives a seen byte of count c the probability c / (n + d), and
the escape to the next shorter context d / (n + d) (method C); below the empty
context all 256 bytes are equally likely.  The statistics stay as learned
while a text is scored, so a text's code length in a language is exact and does
not depend on what was scored before.  The shortest code wins, ties by name.

``lang_pred`` is ``und`` for a text that is null or has no letter.  ``score`` is
the posterior of the prediction when all languages are equally likely (0 for
``und``).  Learning reads whole texts of a bounded sample: for each language
up to ``SAMPLE`` different texts, those of up to ``SAMPLE_BYTES`` bytes first and
then those with the smallest hash; all it has, if they are fewer.  Longer texts,
which only a language with too few shorter ones needs, are taken until they
have ``SAMPLE * SAMPLE_BYTES`` bytes, the last one whole.  Every language is learned;
of more than ``MODEL_TEXTS / SAMPLE`` languages each gives fewer texts, one at
least, so that all together are no more than ``MODEL_TEXTS``.  Null
languages and null or empty texts teach nothing; with nothing learned every
text is ``und``.  Repeated rows give a row each; an empty table gives none;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.arrow import buffers, mix, send_code, slices, strings
from starloom.operators.joins import fits_broadcast
from starloom.session import stage_table

ORDER = 3

#: Documents of each language that are learned from, at most.
SAMPLE = 600

#: Texts of all languages together that are learned from, at most, while there are no more languages.
MODEL_TEXTS = 64 * SAMPLE

#: Languages whose contexts share a table of code lengths; so tables grow with the texts, not with their square.
TABLE_LANGUAGES = 64

#: Longer texts are scored like any other, but learned from only where a language has too few others.
SAMPLE_BYTES = 1 << 16

UND = "und"


@dataclass
class _Level:
    """Contexts of one length, each with every byte it was followed by in some language."""

    keys: _Lookup  # context and byte in one number
    bits: np.ndarray  # [key, language]: code length of the byte, shorter contexts included
    contexts: _Lookup
    escape: np.ndarray  # [context, language]: code length of the escape; 0 where the context is unknown


class _Lookup:
    """Places of 64-bit keys in a sorted array, by buckets of a hash."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(8, int(4 * len(keys)).bit_length()))
        slot = mix(keys) >> self.shift
        self.order = np.argsort(slot, kind="stable")
        self.keys = keys[self.order]
        self.start = np.searchsorted(slot[self.order], np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))
        self.most = int(np.diff(self.start).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those not there."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys) or not len(keys):
            return out
        slot = (mix(keys) >> self.shift).astype(np.int64)
        at, end, left = self.start[slot], self.start[slot + 1], np.arange(len(keys))
        for _ in range(self.most):
            inside = at < end
            at, end, left, keys = at[inside], end[inside], left[inside], keys[inside]
            same = self.keys[at] == keys
            out[left[same]] = self.order[at[same]]
            at, end, left, keys = at[~same] + 1, end[~same], left[~same], keys[~same]
        return out


class _Tables:
    """The frozen statistics of some languages as tables of code lengths."""

    def __init__(self, counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]):
        """counts: for each language, (keys, counts) by context length."""
        self.languages = sorted(counts)
        self.order = max((len(c) for c in counts.values()), default=1) - 1
        self.levels: list[_Level] = []
        for k in range(self.order + 1):
            known = np.unique(np.concatenate([c[k][0] for c in counts.values()] or [np.zeros(0, np.uint64)]))
            contexts = np.unique(known >> np.uint64(8))
            bits = np.zeros((len(known), len(self.languages)), np.float32)
            escape = np.zeros((len(contexts), len(self.languages)), np.float32)
            shorter = self.bits(known & np.uint64((1 << 8 * k) - 1), k - 1)
            place = np.searchsorted(contexts, known >> np.uint64(8))
            for i, name in enumerate(self.languages):
                keys, n = counts[name][k]
                at = np.searchsorted(contexts, keys >> np.uint64(8))
                total, kinds = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
                seen = total > 0
                escape[seen, i] = np.log2((total + kinds)[seen] / kinds[seen])
                bits[:, i] = shorter[:, i] + escape[place, i]
                bits[np.searchsorted(known, keys), i] = np.log2((total + kinds)[at] / n)
            self.levels.append(_Level(_Lookup(known), bits, _Lookup(contexts), escape))

    def bits(self, keys: np.ndarray, k: int) -> np.ndarray:
        """[key, language]: code lengths of bytes after contexts of k bytes."""
        if k < 0:
            return np.full((len(keys), len(self.languages)), 8, np.float32)
        level = self.levels[k]
        at = level.keys.find(keys)
        if (at >= 0).all():
            return level.bits[at]
        out = np.empty((len(keys), len(self.languages)), np.float32)
        known = at >= 0
        out[known] = level.bits[at[known]]
        rest, inverse = np.unique(keys[~known], return_inverse=True)
        context = level.contexts.find(rest >> np.uint64(8))
        more = self.bits(rest & np.uint64((1 << 8 * k) - 1), k - 1)
        more[context >= 0] += level.escape[context[context >= 0]]
        out[~known] = more[inverse]
        return out

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """[text, language]: code lengths in bits of whole texts."""
        data, at = buffers(texts)
        out = np.zeros((len(texts), len(self.languages)))
        for k, keys, row in byte_grams(data, at, self.order):
            cost = self.bits(keys, k)
            for i in range(len(self.languages)):
                out[:, i] += np.bincount(row, cost[:, i], len(texts))
        return out


class Model:
    """The frozen statistics of all languages."""

    def __init__(self, counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]):
        """counts: for each language, (keys, counts) by context length."""
        self.languages = sorted(counts)
        self.tables = [
            _Tables({name: counts[name] for name in self.languages[i : i + TABLE_LANGUAGES]})
            for i in range(0, len(self.languages), TABLE_LANGUAGES)
        ]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """[text, language]: code lengths in bits of whole texts."""
        return np.concatenate([np.zeros((len(texts), 0)), *[t.lengths(texts) for t in self.tables]], 1)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, bits a byte of the shortest code) of each text."""
        n = len(texts)
        letter = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False) if n else np.zeros(0, bool)
        if not self.languages:
            return [UND] * n, np.zeros(n), np.full(n, np.inf)
        lower = pc.utf8_lower(texts)
        lengths = self.lengths(lower)
        best = lengths.argmin(1)
        least = lengths[np.arange(n), best]
        score = 1 / np.exp2(np.clip(least[:, None] - lengths, -1000, 0)).sum(1)
        size = np.maximum(np.diff(buffers(lower)[1]), 1)
        names = [self.languages[i] if ok else UND for i, ok in zip(best, letter)]
        return names, np.where(letter, score, 0.0), np.where(letter, least / size, np.inf)


def byte_grams(data: np.ndarray, at: np.ndarray, order: int):
    """(context length, context and byte in one number, text) of every byte.

    A byte's context are the ``order`` bytes before it, fewer at a text's begin.
    """
    size = np.diff(at)
    row = np.repeat(np.arange(len(size)), size)
    wide = data.astype(np.uint64)
    keys = np.zeros(max(len(data) - order, 0), np.uint64)
    for j in range(order + 1):
        keys = keys << np.uint64(8) | wide[j : j + len(keys)]
    inside = row[order:] == row[: len(keys)]
    yield order, keys[inside], row[order:][inside]
    for k in range(order):
        texts = np.flatnonzero(size > k)
        keys = np.zeros(len(texts), np.uint64)
        for j in range(k + 1):
            keys = keys << np.uint64(8) | wide[at[:-1][texts] + j]
        yield k, keys, texts


def _counts(order: int):
    """Task: how often each byte followed each context, for every context length."""

    def task(batches):
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            for a, b in slices(texts):
                for name in sorted(set(names[a:b])):
                    own = texts[a:b].filter(pa.array([x == name for x in names[a:b]]))
                    data, at = buffers(pc.utf8_lower(own))
                    found: dict[int, list] = {}
                    for k, keys, _ in byte_grams(data, at, order):
                        for shorter in range(k + 1):  # a byte counts in each of its contexts
                            found.setdefault(shorter, []).append(keys & np.uint64((1 << 8 * (shorter + 1)) - 1))
                    for k, keys in found.items():
                        known, n = np.unique(np.concatenate(keys), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(known), pa.string()), pa.array(np.full(len(known), k, np.int32)),
                             pa.array(known.view(np.int64)), pa.array(n.astype(np.int64))],
                            ["lang", "k", "key", "n"],
                        )

    return task


def learn(labelled: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> Model:
    """The model of the languages in ``lang``; see the module for the sample."""
    send_code(labelled.sparkSession)
    if not 0 <= order <= 7:
        raise ValueError("order must be between 0 and 7")
    usable = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        "lang IS NOT NULL AND octet_length(text) > 0"
    )
    # long texts have the upper half of the numbers, so they come last
    upper = F.when(F.octet_length("text") > SAMPLE_BYTES, F.lit(1 << 62)).otherwise(F.lit(0).cast("long"))
    by_hash = usable.withColumn("h", upper + F.shiftrightunsigned(F.xxhash64("text"), 2))
    # copies of a text have one hash and count once
    kinds = stage_table(by_hash.groupBy("lang").agg(F.approx_count_distinct("h").alias("d")), "languages")
    languages = kinds.count()
    if not languages:
        return Model({})
    sample = max(1, min(sample, MODEL_TEXTS // languages))
    chosen = _smallest(by_hash, kinds, sample)
    table = (
        chosen.select("lang", "text").repartition(64, F.xxhash64("text"))
        .mapInArrow(_counts(order), "lang string, k int, key long, n long")
        .groupBy("lang", "k", "key").agg(F.sum("n").alias("n")).toArrow()
    )
    names = table.column("lang").combine_chunks().dictionary_encode()
    group = names.indices.to_numpy().astype(np.int64) * (order + 1) + table.column("k").to_numpy()
    keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    by = np.lexsort((keys, group))
    keys, n = keys[by], n[by]
    cuts = np.searchsorted(group[by], np.arange(len(names.dictionary) * (order + 1) + 1))
    return Model({
        name: [(keys[cuts[i] : cuts[i + 1]], n[cuts[i] : cuts[i + 1]]) for i in range(j * (order + 1), (j + 1) * (order + 1))]
        for j, name in enumerate(names.dictionary.to_pylist())
    })


def _smallest(by_hash: DataFrame, kinds: DataFrame, sample: int) -> DataFrame:
    """(lang, text) of the ``sample`` smallest hashes ``h`` of each language; ``kinds`` has about how many ``d`` there are.

    Rows are cut at a share of the hashes below which enough should lie.  The
    share of a language that then has too few grows until it has enough or all
    of its hashes are taken.
    """
    spread = 2.0  # short texts lie in half of the numbers, so four times the sample is found
    few, done = kinds.select("lang", "d"), None
    while True:
        share = F.least(F.lit(1.0), F.lit(spread * sample) / F.col("d")).alias("share")
        shares = few.select("lang", share)
        shares = F.broadcast(shares) if fits_broadcast(few) else shares
        found = stage_table(
            by_hash.join(shares, "lang").where(F.col("h") / F.lit(float(1 << 63)) <= F.col("share"))
            .groupBy("lang", "h").agg(F.min("text").alias("text"))
            .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
            .where(F.col("n") <= sample)
            .withColumn("earlier", F.coalesce(F.sum(F.octet_length("text")).over(
                Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .select("lang", "text", "earlier"),
            "sample",
        )
        done = found if done is None else done.join(few.select("lang"), "lang", "left_anti").unionByName(found)
        cut = few.where(F.lit(spread * sample) < F.col("d"))
        full = found.groupBy("lang").count().where(F.col("count") >= sample).select("lang")
        few = stage_table(cut.join(full, "lang", "left_anti"), "few")
        if not few.count():
            return done.where(F.col("earlier") < SAMPLE * SAMPLE_BYTES).select("lang", "text")
        spread *= 16


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    send_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                names, score, _ = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(task, "doc_id long, lang_pred string, score double")


def known_language(docs: DataFrame, model: Model) -> DataFrame:
    """The documents in a learned language, with all columns.

    Rejected are ``und`` and texts that no language codes in less than the eight
    bits a byte that they have anyway.
    """
    send_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(column))
            for a, b in slices(texts):
                _, _, bits = shared.value.predict(texts[a:b])
                yield batch.slice(a, b - a).filter(pa.array(bits < 8))

    return docs.mapInArrow(task, docs.schema)


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def labelled_part(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out())
