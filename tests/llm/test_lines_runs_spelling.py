"""Line dedup, periodic runs and spelling variants on awkward rows, and against plain versions of themselves."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("starloom.llm")

from test_small import DOCS, LONG, TEXTS, plain_rows  # noqa: E402

from starloom.llm import linededup, queries, runs, spelling  # noqa: E402
from starloom.session import stage_table  # noqa: E402

#: Columns whose names the three operators use themselves.
CLASH = "doc_id long, text string, word string, n long, key string, t1 long, line int, lost string, size int, h long, w string, runs int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 2, "p", "k", 3) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, "Alpha beta", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "k", 1, 1, "l", 1, 1, "w", 1) for i, t in rows], CLASH).repartition(5)


# --- lines ------------------------------------------------------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def lines_by_force(rows, min_docs, min_chars):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(lower(line.strip(WHITE)), set()).add(i)
    out = []
    for i, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = lower(line.strip(WHITE))
            ids = holders[key]
            if len(key) < min_chars or len(ids) < min_docs or i == min(x for x in ids if x is not None):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


LINES = ["A shared line", "a SHARED line\t", "  a shared line\r", "ten chars.", "nine char", "ééééééééé", "éééééééééé", "",
         "ÀÀÀÀÀÀÀÀÀÀ", "àààààààààà", "\x0ba line with \x85 inside\x0c", "漢字漢字漢字漢字漢字", "only once", " a shared line"]


@pytest.mark.parametrize("min_docs, min_chars", [(2, 10), (3, 1), (2, 4)])
def test_lines(spark, min_docs, min_chars):
    draw = random.Random(min_chars)
    rows = [(draw.choice([None, *range(30)]), "\n".join(draw.choices(LINES, k=draw.randint(0, 12)))) for _ in range(80)]
    rows += [(99, "A shared line\n" * 5000), (98, None), (97, ""), (96, "\n\n"), rows[0], rows[0]]
    got = linededup.dedup_lines(clashing(spark, rows), min_docs, min_chars)
    assert rows_of(got) == lines_by_force(rows, min_docs, min_chars)


@pytest.mark.parametrize("hot_keys", [1, 3, 10**9])
def test_frequent_lines_take_another_way_to_the_same_result(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(linededup, "HOT_KEYS", hot_keys)
    rows = [(i, f"a line in every document\nown line of {i}\nshared by {i % 7} in seven") for i in range(60)]
    got = linededup.dedup_lines(clashing(spark, rows))
    assert rows_of(got) == lines_by_force(rows, 2, 10)


def test_lines_of_awkward_rows(docs, empty):
    assert rows_of(linededup.dedup_lines(docs)) == lines_by_force(plain_rows(), 2, 10)
    assert linededup.dedup_lines(empty).count() == 0


# --- runs -------------------------------------------------------------------------------------------------------


def runs_by_force(words):
    """Every stretch, period by period, straight from the definition."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(24, 3 * q):
                part = words[start:end]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((start, end - start, q))
            start = max(end - q, start) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_small_alphabets():
    draw = random.Random(3)
    found = 0
    for _ in range(400):
        block = [draw.choices("ab" if draw.random() < 0.7 else "abcd", k=draw.randint(1, 9)) for _ in range(2)]
        words = []
        while len(words) < draw.randint(20, 300):
            words += draw.choice(block) * draw.choice([1, 1, 2, 3, 9, 30]) if draw.random() < 0.9 else draw.choices("abc", k=3)
        ids = np.unique(words, return_inverse=True)[1]
        expected = runs_by_force(words)
        assert runs.find_runs(ids) == expected
        found += len(expected)
    assert found > 400


def test_runs_whose_seeds_repeat_within_the_period():
    # every long gram of a block u x u x u y u y occurs more than once in the block
    u, x, y = list(range(100, 130)), [1], [2]
    for block in ((u + x) * 2 + (u + y) * 2, u * 2 + x + u + y, list(range(40)) * 2 + [7]):
        for times in (3, 4):
            words = [0, 0, *(block * times), *block[:3], 0]
            assert runs.find_runs(np.array(words)) == runs_by_force(words) != []


def test_runs_of_one_word_take_linear_time():
    n = 400_000
    assert runs.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    mixed = np.concatenate([np.tile([1, 2], n // 4), np.tile(np.arange(1000), n // 2000)])
    assert [r[2] for r in runs.find_runs(mixed)] == [2, 1000]


def test_every_period_has_a_class_with_its_overlap():
    classes = runs.lag_classes(5000)
    assert [q for low, high in classes for q in range(low, high)] == list(range(1, 5001))
    for low, high in classes:
        k = runs.least_overlap(low, high)
        assert all(max(24 - q, 2 * q) >= k >= runs.SEED for q in range(low, high))
        # a period of at most k / 4 and a lag of the class meet within the gram
        assert low <= 2 or k // 4 + high - 1 <= k
    assert runs.SEED == 16


def plain_run_rows(rows):
    out = []
    for i, text in rows:
        words = [w for w in "".join(" " if c in WHITE else c for c in text or "").split(" ") if w]
        found = runs_by_force(words)
        lost = {k for s, n, q in found for k in range(s + q, s + n)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        out.append((i, len(words), len(found), *best, [tuple(r) for r in found],
                    " ".join(w for k, w in enumerate(words) if k not in lost)))
    return sorted(out, key=repr)


def test_runs_of_awkward_rows(spark, docs, empty):
    got = sorted(((*r[:6], [tuple(x) for x in r[6]], r[7]) for r in runs.periodic_runs(docs).collect()), key=repr)
    assert got == plain_run_rows(plain_rows())
    assert runs.periodic_runs(empty).count() == 0
    tie = "a b c " * 8 + "x " + "d e f " * 8 + "Word\x85word " * 24 + "  " * 24
    rows = [(1, tie), (None, tie), (1, tie), (2, "A a " * 12), (3, " w\tw\nw\x0bw\x0cw\rw" * 4)]
    got = sorted(((*r[:6], [tuple(x) for x in r[6]], r[7]) for r in runs.periodic_runs(clashing(spark, rows)).collect()), key=repr)
    assert got == plain_run_rows(rows)


def test_looped_texts(spark):
    import zlib

    rows = [(i, " ".join(f"w{j}" for j in range(draw)) + "\n") for i, draw in enumerate(random.Random(4).choices(range(90), k=300))]
    rows += [(None, "a b"), (7, None), (8, "")]
    got = {}
    for r in queries.looped(clashing(spark, rows)).collect():
        got.setdefault(r[0], []).append(r[1])
    for i, text in rows:
        words, expected = (text or "").split(), text
        if i is not None:
            h = zlib.crc32(str(i).encode())
            n, g = len(words), h // 10
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                expected = " ".join(words[j] if j < a else words[a + (j - a) % p] for j in range(n))
        assert expected in got[i]


# --- spelling ---------------------------------------------------------------------------------------------------


def distance_is_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_force(count, ratio):
    near = {w: [v for v in count if distance_is_one(v, w)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), None if form[w] is None else count[form[w]]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [0, 1, 16])
def test_variants(spark, most):
    draw = random.Random(most)
    words = {"".join(draw.choices("abé", k=draw.randint(1, 8))) for _ in range(500)}
    words |= {f"shared{c}{d}" for c in "abcdefghij" for d in "abcdefghijklm"} | {"shared", "internat", "internation", "ÿ", "🙂🙂"}
    count = {w: draw.choice([5, 5, 6, 30, 200, 5000, 100_000]) for w in words}
    table = stage_table(spark.createDataFrame(list(count.items()), "word string, n long").repartition(4))
    assert rows_of(spelling.spelling_variants(table, 5, most)) == variants_by_force(count, 5)
    pairs = [(r["a"], r["b"]) for r in spelling.near_pairs(table, most).collect()]
    assert len(pairs) == len(set(pairs)) and all(distance_is_one(a, b) for a, b in pairs)


def test_hot_chunks_do_not_join_all_pairs(spark):
    # one chunk holds all words, but few of them are near
    words = [f"prefix{i:06d}" for i in range(0, 4000, 37)] + [f"{i:06d}suffix" for i in range(0, 4000, 37)]
    table = stage_table(spark.createDataFrame([(w, 5) for w in words], "word string, n long"))
    owners, grams = spelling._owners(table), spelling._grams(table)
    hot = stage_table(spelling._hot_chunks(owners, grams, 4))
    assert hot.count() > 0
    places = spelling._told_apart(owners, hot, True).select("place").join(
        spelling._told_apart(grams, hot, False).select("place"), "place").count()
    assert places < 40 * len(words) < len(words) ** 2 / 4


def test_long_chains_of_forms(spark):
    words, n = ["ababab"], 4 * 10**6
    for k in range(9):
        words.append(words[-1] + "xyz"[k % 3])
    count = {w: n // 5**i for i, w in enumerate(words)}
    table = stage_table(spark.createDataFrame(list(count.items()), "word string, n long"))
    got = rows_of(spelling.spelling_variants(table, 5))
    assert got == variants_by_force(count, 5) and {r[2] for r in got} == {"ababab"}


def test_vocabulary_of_awkward_rows(spark, docs, empty):
    import re

    count = Counter(w for _, t in plain_rows() for w in re.findall("[A-Za-zÀ-ÿ]+", lower(t or "")) if len(w) >= 4)
    got = spelling.vocabulary(spelling.runs_of_letters(docs), 4, 2)
    assert rows_of(got) == sorted((w, n) for w, n in count.items() if n >= 2)
    assert spelling.spelling_variants(stage_table(spelling.vocabulary(spelling.runs_of_letters(empty)))).count() == 0
    rows = [(1, "Straße×Wort÷É ÉCOLE École école_ecole LONGĀlong"), (None, "STRASSE"), (2, None), (2, "")]
    found = spelling.runs_of_letters(clashing(spark, rows))
    assert sorted(r["word"] for r in found.collect()) == sorted(
        ["straße×wort÷É", "École", "École", "école", "ecole", "long", "long", "strasse"])


def test_misspelt_words(spark):
    import zlib

    draw = random.Random(8)
    rows = [(draw.randint(0, 9), "".join(draw.choices("abcdé", k=draw.randint(1, 9)))) for _ in range(3000)] + [(None, "kept")]
    expected = []
    for i, w in rows:
        h = 1 if i is None else zlib.crc32(f"{i}:{w}".encode())
        expected.append(w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w)
    got = queries.misspelt(spark.createDataFrame(rows, "doc_id long, word string"))
    assert sorted(r[0] for r in got.collect()) == sorted(expected)


def test_long_texts(spark):
    rows = [(1, LONG), (2, "abcdef " * 300_000), (3, "abcdefgh" * 100_000)]
    table = clashing(spark, rows)
    assert linededup.dedup_lines(table).where("doc_id = 2").first()["n_dropped"] == 0
    assert [r["n_runs"] for r in runs.periodic_runs(table).orderBy("doc_id").collect()][1:] == [1, 0]
    assert spelling.vocabulary(spelling.runs_of_letters(table)).where("word = 'abcdef'").first()["n"] == 300_000
