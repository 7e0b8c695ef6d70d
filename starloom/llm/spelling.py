"""Spelling variants: words one edit apart, found by asymmetric q-chunks, grouped under their frequent forms.

Words are maximal runs of letters (``LETTERS``), with A-Z as a-z, of at least
``min_chars`` code points and at least ``min_count`` occurrences in all texts.  Two
words are near if they differ by exactly one inserted, deleted or replaced code
point.  A word's form is its near word of largest count (ties: the smallest in
code-point order) if that count is at least ``ratio`` times its own, else null.
The root is where following forms ends.

*Chunks and grams.*  Of two near words the longer one (of equally long ones the
greater) contributes two disjoint chunks, its first and its last ``length // 2``
code points.  One edit leaves at least one of them whole.  The other word
contributes its grams of that size; a chunk at P is met by the gram at P, or at
P - 1 where the edit, a deletion, lies before it.  So grams are made at these
places only and the join is one on equal (length, chunk, text).  Candidates
are verified by their edit distance.  A pair whose two chunks both survive is
taken by the first one.

*Hot chunks.*  Where a chunk joins more than ``MOST_CANDIDATES`` candidates for each
word that has it, both sides are told apart further: by the place of the edit in
the rest of the word and by the rest without that code point.  Words that
agree in all of it differ in one code point only, so such a group has no more members than
there are letters, and no pair is lost or emitted in vain.

Everything is DataFrame code: words are counted map-side first, so texts
and frequent words do not move.  The root is found by joining forms with forms; each
step of a chain multiplies the count by ``ratio`` at least, so a few rounds do.

Null and empty texts have no words.  Repeated rows count as often as they occur.  An
empty table, or one without words, gives no row.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import lookup_join
from starloom.session import stage_table

LETTERS = r"[A-Za-zÀ-ÿ]+"

#: Candidates of a chunk for each word that has it, before the chunk counts as hot.
MOST_CANDIDATES = 16

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def runs_of_letters(docs: DataFrame) -> DataFrame:
    """(doc_id, word): every maximal run of letters, with A-Z as a-z."""
    found = F.regexp_extract_all(lower(F.col("text").cast("string")), F.lit(LETTERS), F.lit(0))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(found).alias("word"))


def vocabulary(runs: DataFrame, min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (
        runs.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def _part(word: str, first: str, size: str) -> str:
    """SQL for ``size`` code points of ``word`` from ``first``, counted from 0."""
    return f"substring({word}, {first} + 1, {size})"


def _owners(words: DataFrame) -> DataFrame:
    """Two chunks of every word, with the rest of the word on the other side."""
    return words.selectExpr("word", "n", "char_length(word) AS size", "explode(array(true, false)) AS head").selectExpr(
        "word", "n", "size", "head", "0 AS shorter",
        f"IF(head, {_part('word', '0', 'size div 2')}, {_part('word', 'size - size div 2', 'size')}) AS chunk",
        f"IF(head, {_part('word', 'size div 2', 'size')}, {_part('word', '0', 'size - size div 2')}) AS rest",
    )


def _grams(words: DataFrame) -> DataFrame:
    """The grams that chunks of words as long, or one longer, can meet; ``size`` is that of the chunk's word."""
    return words.selectExpr(
        "word", "n", "char_length(word) AS own", "explode(array(true, false)) AS head").selectExpr(
        "*", "explode(array(0, 1)) AS shorter").selectExpr("*", "own + shorter AS size").selectExpr(
        "word", "n", "size", "head", "shorter",
        # an edit before the last chunk moves the gram to the front by what the word is shorter
        f"IF(head, {_part('word', '0', 'size div 2')}, {_part('word', 'own - size div 2', 'own')}) AS chunk",
        f"IF(head, {_part('word', 'size div 2', 'own')}, {_part('word', '0', 'own - size div 2')}) AS rest",
    )


_KEY = "concat_ws(' ', size, head, chunk)"


def _hot_chunks(owners: DataFrame, grams: DataFrame, most: int) -> DataFrame:
    """(key, hot): chunks with too many candidates."""
    both = owners.selectExpr(f"{_KEY} AS key", "1 AS o", "0 AS g").unionByName(
        grams.selectExpr(f"{_KEY} AS key", "0 AS o", "1 AS g"))
    return (
        both.groupBy("key").agg(F.sum("o").alias("o"), F.sum("g").alias("g"))
        .where(F.col("o") * F.col("g") > most * (F.col("o") + F.col("g")))
        .select("key", F.lit(True).alias("hot"))
    )


_WITHOUT = "concat(substring(rest, 1, i - 1), substring(rest, i + 1))"


def _told_apart(rows: DataFrame, hot: DataFrame, chunks: bool) -> DataFrame:
    """Rows with the keys they are joined by: the chunk, or for a hot one its refinements."""
    keyed = lookup_join(rows.selectExpr("*", f"{_KEY} AS key"), hot, "key", "left", ["word", "shorter"])
    places = "sequence(1, char_length(rest))"
    replaced = f"transform({places}, i -> concat_ws(' ', key, i, {_WITHOUT}))"
    dropped = f"transform({places}, i -> concat_ws(' ', key, '-', {_WITHOUT}))"
    # a rest is empty only where a word of one code point is looked for
    finer = (f"IF(rest = '', array(), concat({replaced}, array_distinct({dropped})))" if chunks else
             f"IF(shorter = 1, array(concat_ws(' ', key, '-', rest)), IF(rest = '', array(), {replaced}))")
    return keyed.selectExpr(
        "word", "n", "size", "head", "shorter", f"explode(IF(hot, {finer}, array(key))) AS place")


def near_pairs(words: DataFrame, most: int | None = None) -> DataFrame:
    """(a, n_a, b, n_b): every two near words of the stored table (word, n), once; a is the longer or greater."""
    owners, grams = _owners(words), _grams(words)
    hot = stage_table(_hot_chunks(owners, grams, MOST_CANDIDATES if most is None else most), "spelling_hot")
    a = _told_apart(owners, hot, True).selectExpr("word AS a", "n AS n_a", "size", "head", "place")
    b = _told_apart(grams, hot, False).selectExpr("word AS b", "n AS n_b", "shorter", "place")
    return (
        a.join(b, "place").where("(shorter = 1 OR a > b) AND levenshtein(a, b, 1) = 1")
        # the last chunk's pairs are new only where the first one does not join them
        .where("head OR left(a, size div 2) <> left(b, size div 2)")
        .select("a", "n_a", "b", "n_b")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form, given as a stored table (word, form)."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        nxt = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        open_ = now.join(nxt, F.col("root") == F.col("via"), "left")
        step = stage_table(open_.select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling_roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, ratio: int = 5, most: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of the stored table (word, n)."""
    pairs = stage_table(near_pairs(words, most), "spelling_pairs")
    both = pairs.selectExpr("a AS word", "n_a AS n", "b AS near", "n_b AS m").unionByName(
        pairs.selectExpr("b AS word", "n_b AS n", "a AS near", "n_a AS m"))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), "near")).alias("best"))
    known = stage_table(best.selectExpr(
        "word", "n_near", f"IF(-best.minus >= {ratio} * n, best.near, NULL) AS form",
        f"IF(-best.minus >= {ratio} * n, -best.minus, NULL) AS form_n"), "spelling_forms")
    roots = _roots(known.where("form IS NOT NULL").select("word", "form"))
    return (
        words.join(known, "word", "left").join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )
