"""Every operator on small tables with awkward rows, and against plain versions of itself."""

import hashlib
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("starloom.llm")

import public_tokenizers  # noqa: E402

from starloom.llm import (  # noqa: E402
    bpe,
    decontaminate,
    html,
    language,
    simhash,
    tokenbin,
    tokencount,
    topk,
    toxicity,
    warc,
)
from starloom.llm.arrow import strings  # noqa: E402

#: A table with columns whose names the operators could use themselves.
DOCS = "doc_id long, text string, lang string, source string, fp long, n int, path string, key string, root long"

LONG = "".join(random.Random(5).choices("abcdefgh ,.é\n", k=40_000))

TEXTS = [
    None, "", " \n\t ", "?!", "Alpha beta", "alpha  BETA", "one two three four five six seven eight nine ten eleven",
    "ONE two three four five six seven eight nine ten twelve", "ß é 漢字 👍 İ", "word " * 3000, LONG, LONG, "x" * 30_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 2, "p", "k", 3) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, "Alpha beta", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


def plain_rows():
    rows = list(enumerate(TEXTS))
    return [*rows, rows[6], rows[6], (None, "Alpha beta")]


# --- decontamination --------------------------------------------------------------------------------------------

ITEMS = [
    (1, "x one TWO three four five six seven eight nine ten"), (2, "alpha, beta"), (2, "alpha, beta"), (3, None),
    (4, ""), (None, "word word word"), (10, "two three four five six seven eight nine ten eleven y"), (5, LONG[5000:5400]),
]


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination_by_force(rows, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(len(w) - 9) if len(w) >= 10 else range(bool(w)):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in rows:
        w, hit, found = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (t := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[t]
        found = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("index_bytes", [1 << 20, 0])
def test_contamination(spark, docs, empty, index_bytes):
    items = spark.createDataFrame([(*x, 1) for x in ITEMS], "item_id long, text string, doc_id int")
    columns = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = contamination_by_force(plain_rows(), ITEMS)
    assert by_id(decontaminate.contamination(docs, items, index_bytes), *columns) == expected
    clean = decontaminate.clean_documents(docs, items, index_bytes)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(x[0] for x in expected if not x[5])
    assert decontaminate.contamination(empty, items, index_bytes).count() == 0
    none = decontaminate.contamination(docs, items.limit(0), index_bytes)
    assert none.where("contaminated").count() == 0 and none.count() == docs.count()


def test_winnowing_misses_nothing(spark):
    """Shared runs of ten words at random places are found, by either way of joining."""
    draw = random.Random(3)
    items = [(i, " ".join(draw.choices("abcdef", k=draw.randint(1, 40)))) for i in range(30)]
    rows = []
    for i in range(60):
        w = draw.choices("abcdefgh", k=draw.randint(0, 60))
        source = items[draw.randrange(30)][1].split()
        at = draw.randint(0, len(w))
        rows.append((i, " ".join(w[:at] + source[draw.randint(0, 3) :] + w[at:])))
    left = spark.createDataFrame(rows, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    expected = contamination_by_force(rows, items)
    for size in (1 << 20, 0):
        got = decontaminate.contamination(left, right, size)
        assert by_id(got, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected


@pytest.mark.parametrize("index_bytes", [1 << 20, 0])
def test_item_ids_with_colons(spark, index_bytes):
    items = [("mmlu:12", "one two three"), ("mmlu:13", "four five six"), ("a:", "one two three"), (":b:c", "one two three")]
    rows = [(1, "x one two three y four five six"), (2, "four five six")]
    left = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(left, spark.createDataFrame(items, "item_id string, text string"), index_bytes)
    assert by_id(got, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == contamination_by_force(rows, items)


def test_no_text_moves_before_hashes_are_compared(spark, monkeypatch):
    seen = []
    cut = decontaminate._windows_at
    monkeypatch.setattr(decontaminate, "_windows_at", lambda texts, spots: seen.append((texts, spots)) or cut(texts, spots))
    docs = spark.createDataFrame([(i, f"w{i} " * 12) for i in range(50)], "doc_id long, text string")
    items = docs.where("doc_id < 3").withColumnRenamed("doc_id", "item_id")
    assert decontaminate.contamination(docs, items, 0).where("contaminated").count() == 3
    texts, spots = seen[-1]
    assert spots.dtypes == [("key", "string"), ("n", "bigint"), ("place", "bigint")]
    plan = spots._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "words" not in plan
    assert spots.select("key").distinct().count() == 3


# --- SimHash ----------------------------------------------------------------------------------------------------


def fingerprint_by_force(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components_by_force(prints):
    known = sorted(set(prints))
    root = {x: x for x in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(known):
        for y in known[i + 1 :]:
            if (x ^ y).bit_count() <= 3:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {x: find(x) for x in known}


def test_fingerprints():
    draw = random.Random(1)
    texts = TEXTS + [" ".join(draw.choices(["A", "b", "cc"], k=n)) for n in (1, 2, 3, 4, 300, 800)] + ["\x0b\x0c a\x1cb c\x0b"]
    got = simhash.fingerprints(strings(pa.array(texts, pa.string())))
    assert [int(x) for x in got] == [fingerprint_by_force(t) for t in texts]


def planted_prints(draw, groups, size):
    out = [0, (1 << 64) - 1]
    for _ in range(groups):
        base = draw.getrandbits(64)
        for _ in range(size):
            value = base
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                value ^= 1 << bit
            out.append(value)
    return out + [draw.getrandbits(64) for _ in range(200)] + [draw.getrandbits(10) << 54 for _ in range(40)]


@pytest.mark.parametrize("node_rows", [7, 64, 100_000])
def test_trie_join(spark, node_rows):
    prints = planted_prints(random.Random(node_rows), 12, 30)
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in prints})
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["fp"] % (1 << 64): r["root"] for r in simhash.components(df, node_rows).collect()}
    expected = components_by_force(prints)
    assert got.keys() == expected.keys()
    pairs = {(got[x], expected[x]) for x in got}
    assert len(pairs) == len(set(got.values())) == len(set(expected.values()))


def test_chain_of_links(spark):
    """A long path of links is one component, wherever the trie is cut."""
    value, chain = 0, []
    for bit in random.Random(2).sample(range(64), 60):
        value ^= 1 << bit
        chain.append(value - (1 << 64) if value >> 63 else value)
    df = spark.createDataFrame([(x,) for x in chain], "fp long")
    assert simhash.components(df, 3).select("root").distinct().count() == 1


def test_simhash_components(docs, empty):
    prints = {i: fingerprint_by_force(t) for i, t in enumerate(TEXTS)}
    root = components_by_force(prints.values())
    least = {}
    for i, x in prints.items():
        least[root[x]] = min(least.get(root[x], i), i)
    expected = [
        (i, f"{fingerprint_by_force(t):016x}", least[root[fingerprint_by_force(t)]]) for i, t in plain_rows()
    ]
    assert by_id(simhash.simhash_components(docs), "fingerprint", "component_id") == sorted(expected, key=repr)
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.keep_one(empty).count() == 0


def test_columns_of_any_name_pass_the_dedup_stage(spark):
    rows = [(1, "one text", 5, "x", 7, 8), (2, "one text", 6, "y", 7, 8), (3, "quite another one", 7, "z", 9, 9)]
    named = spark.createDataFrame(rows, "doc_id long, text string, _llm_fp long, _LLM_KEY string, _llm_n int, _LLM_FP_ int")
    kept = simhash.keep_one(named)
    assert kept.columns == named.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def test_components_without_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (4, "k l m n o")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(df).collect()) == ["a b c d", "k l m n o", "q r s t u"]


# --- language ---------------------------------------------------------------------------------------------------


def ppm_by_force(samples, text, order):
    """Code length of ``text`` in bits, from dictionaries of counts."""
    counts = [{} for _ in range(order + 1)]
    for sample in samples:
        data = sample.lower().encode()
        for i in range(len(data)):
            for k in range(min(i, order) + 1):
                after = counts[k].setdefault(data[i - k : i], {})
                after[data[i]] = after.get(data[i], 0) + 1
    data, bits = text.lower().encode(), 0.0
    for i in range(len(data)):
        for k in range(min(i, order), -1, -1):
            after = counts[k].get(data[i - k : i])
            if after is None:
                continue
            total, kinds = sum(after.values()), len(after)
            if data[i] in after:
                bits += np.log2((total + kinds) / after[data[i]])
                break
            bits += np.log2((total + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    samples = {"a": ["the cat sat on the mat", "a hat"], "b": ["der hund und die katze", "und"], "c": ["ñandú é ß"]}
    rows = [(x, t) for x, texts in samples.items() for t in texts]
    rows += [("a", "the cat sat on the mat"), ("b", None), (None, "zzz"), ("c", "")]
    texts = ["The cat", "die Katze und", "", "qqq", "é", "漢字 the", "x"]
    for order in (0, 2, 3, 5):
        model = language.learn(spark.createDataFrame(rows, "lang string, text string"), order=order)
        assert model.languages == ["a", "b", "c"]
        got = model.lengths(strings(pa.array([t.lower() for t in texts])))
        expected = [[ppm_by_force(samples[x], t, order) for x in "abc"] for t in texts]
        np.testing.assert_allclose(got, expected, rtol=1e-5)


def test_language_of_awkward_rows(spark, docs, empty):
    model = language.learn(docs.select("doc_id", "text", "lang"))
    got = language.identify(docs, model)
    assert {r["lang_pred"] for r in got.where("doc_id IN (0, 1, 2, 3)").collect()} == {"und"}
    assert {r["lang_pred"] for r in got.where("doc_id IN (4, 10, 12)").collect()} == {"en"}
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert got.count() == docs.count() and language.identify(empty, model).count() == 0
    kept = language.known_language(docs, model)
    assert kept.columns == docs.columns
    assert not {0, 1, 2, 3} & {r["doc_id"] for r in kept.collect()}
    nothing = language.learn(empty)
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", language.held_out().alias("h")).collect()}
    assert held == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in [*range(len(TEXTS)), None]}
    learned = {r["doc_id"] for r in language.labelled_part(docs).collect()}
    assert learned == {i for i, h in held.items() if not h} - {None}


def test_a_language_of_copies_is_learned(spark):
    """As many different texts as asked for are found, however many copies there are."""
    draw = random.Random(8)
    rows = [("a", "alpha beta gamma " + str(i)) for i in range(300)]
    rows += [("b", "der hund und die katze")] * 20_000 + [("b", f"ein anderer satz {i}") for i in range(30)]
    rows += [("c", " ".join(draw.choices("xyzuvw", k=9)) + str(i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    for sample in (1, 5, 30, 600):
        usable = df.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
        for times in (1, 100_000):  # a count that is far too high, too, costs no text
            kinds = usable.groupBy("lang").agg((F.approx_count_distinct("h") * times).alias("d"))
            got = language._smallest(usable, kinds, sample).groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("text").alias("d"))
            assert sorted(map(tuple, got.collect())) == [
                (x, min(sample, n), min(sample, n)) for x, n in (("a", 300), ("b", 31), ("c", 5000))]
    model = language.learn(df, sample=5)
    assert model.languages == ["a", "b", "c"]
    assert model.predict(strings(pa.array(["hund und katze", "beta gamma"])))[0] == ["b", "a"]


def test_a_language_of_long_texts_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_BYTES", 500)
    draw = random.Random(9)
    rows = [("en", " ".join(draw.choices(["the", "and", "with", "from"], k=40))) for _ in range(30)]
    rows += [("xx", " ".join(draw.choices(["zug", "wqz", "kvj"], k=400))) for _ in range(8)]
    rows += [("yy", " ".join(draw.choices(["ooo", "uu"], k=20))) for _ in range(2)] + [("yy", "iiii " * 300)]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    model = language.learn(labelled, sample=5)
    docs = spark.createDataFrame([(0, "the and from"), (1, "zug kvj zug wqz"), (2, "uu ooo uu"), (3, "iiii iiii")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(docs, model).orderBy("doc_id").collect()] == ["en", "xx", "yy", "yy"]
    # short texts come first: a long one is left out where there are enough
    few = language.learn(spark.createDataFrame([r for r in rows if r[0] == "en"] + [("en", "qqqq " * 300)], "lang string, text string"), sample=5)
    own = language.identify(spark.createDataFrame([(0, "qqqq")], "doc_id long, text string"), few).first()
    assert own["lang_pred"] == "en" and few.predict(strings(pa.array(["qqqq"])))[2][0] > 7


def test_every_language_is_learned(spark):
    draw = random.Random(6)
    vocabulary = {f"l{i:02}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(5)] for i in range(70)}
    rows = [(x, " ".join(w + w[: j % 3] for w in words)) for x, words in vocabulary.items() for j in range(3 if x < "l60" else 1)]
    model = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == sorted(vocabulary) and len(model.tables) == 2
    texts = [" ".join(words) for words in vocabulary.values()]
    assert model.predict(strings(pa.array(texts)))[0] == sorted(vocabulary)
    few = language.learn(spark.createDataFrame(rows, "lang string, text string"), sample=1)
    assert few.languages == sorted(vocabulary)


# --- toxicity ---------------------------------------------------------------------------------------------------


def severe(spark, n, seed):
    draw = random.Random(seed)
    filler = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = draw.choices(filler, k=draw.randint(20, 200))
        bad = i % 3 == 0
        if bad:
            w += ["vile" + draw.choice(filler) for _ in range(draw.randint(1, 12))]
            draw.shuffle(w)
        rows.append((seed * 10_000 + i, " ".join(w), int(bad)))
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int"))


def test_severity_generalises(spark):
    docs, labels = severe(spark, 900, 1)
    model = toxicity.learn(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    other, truth = severe(spark, 300, 2)
    got = {r["doc_id"]: r for r in toxicity.severity(other, model).collect()}
    texts = dict(map(tuple, other.collect()))
    right = [got[r["doc_id"]]["toxic"] == bool(r["toxic"]) for r in truth.collect()]
    assert np.mean(right) > 0.97
    counts = [sum(w.startswith("vile") for w in texts[i].split()) for i in got]
    assert np.corrcoef(counts, [r["severity"] for r in got.values()])[0, 1] > 0.8
    kept = toxicity.civil(other, model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["toxic"]}


def test_small_shares_of_marked_words_are_toxic(spark):
    """Texts of 40 to 1,000 words of which 0.5, 3 or 20 % are marked, by any of twelve words."""
    words = random.Random(0)
    filler = ["".join(words.choices("abcdefgh", k=words.randint(2, 7))) for _ in range(400)]
    marks = ["".join(words.choices("opqrstuv", k=7)) for _ in range(12)]

    def made(seed, n):
        draw, rows = random.Random(seed), []
        for i in range(n):
            size = draw.choice([40, 150, 1000])
            w = draw.choices(filler, k=size)
            if i % 4 == 0:
                w += draw.choices(marks, k=max(1, round(size * draw.choice([0.005, 0.03, 0.2]))))
            draw.shuffle(w)
            rows.append((i, " ".join(w), int(i % 4 == 0)))
        return spark.createDataFrame(rows, "doc_id long, text string, toxic int")

    docs = made(5, 800)
    got = toxicity.severity(made(6, 400), toxicity.learn(docs, docs)).collect()
    assert np.mean([r["toxic"] for r in got if r["doc_id"] % 4 == 0]) > 0.95
    assert np.mean([r["toxic"] for r in got if r["doc_id"] % 4]) < 0.02


def plain_features(text):
    found = []
    for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()):
        found.append(("word", w))
        found += [(n, w.encode()[:n]) for n in toxicity.PREFIXES if len(w.encode()) >= n]
    return found


def test_features_and_grades_against_a_plain_version(spark):
    docs, labels = severe(spark, 300, 6)
    texts, toxic = dict(map(tuple, docs.collect())), dict(map(tuple, labels.select("doc_id", "toxic").collect()))
    n = Counter(toxic.values())
    held = {1: Counter(), 0: Counter()}
    for i, t in texts.items():
        held[toxic[i]].update(set(plain_features(t)))
    strong, marker = set(), set()
    for f in held[0] | held[1]:
        bad, good = held[1][f], held[0][f]
        both = (bad + good) / len(texts)
        z = (bad / n[1] - good / n[0]) / (both * (1 - both) * (1 / n[0] + 1 / n[1]) + 1e-12) ** 0.5
        if bad + good >= toxicity.LEAST_DOCS and abs(z) >= toxicity.LEAST_Z:
            strong.add(f)
            if bad / n[1] > 20 * good / n[0]:
                marker.add(f)
    assert len(strong) > 10 and len(strong) <= toxicity.FEATURES
    ids = sorted(texts)
    row, _, found = toxicity.features(strings(pa.array([texts[i] for i in ids])))
    named = sorted({int(h) for h, r in zip(found, row)})
    model = toxicity.learn(docs, labels)
    assert set(model.vocabulary.tolist()) <= set(named) and len(model.vocabulary) == len(strong)
    # grades by the share of marked words, in thirds
    share = {i: np.mean([any(f in marker for f in plain_features(w)) for w in texts[i].lower().split()]) for i in ids if toxic[i]}
    order = sorted(share.values())
    grade = toxicity.grades_of(np.array([toxic[i] for i in ids]), np.array([share.get(i, 0.0) for i in ids]))
    for i, g in zip(ids, grade):
        assert (g == 0) == (not toxic[i])
        if toxic[i]:
            below = np.mean([x < share[i] for x in order])
            assert below <= g / 3 + 0.01 and np.mean([x <= share[i] for x in order]) >= (g - 1) / 3 - 0.01


def test_the_fit_is_the_best_one():
    """No small change of any parameter makes the weighted likelihood larger, as a plain sum gives it."""
    draw = np.random.default_rng(3)
    n, size, grades = 400, 5, 4
    x = draw.normal(size=(n, size)) * (draw.random((n, size)) < 0.6)
    grade = np.searchsorted([0.0, 1.0, 2.0], x @ [1.5, -1.0, 0.5, 0.0, 0.2] + draw.logistic(0, 0.5, n))
    row, place = np.nonzero(x)

    def loss(w, t):
        total = 0.5e-3 * float(w @ w)
        for xi, g in zip(x, grade):
            edge = [1.0, *(1 / (1 + np.exp(-(xi @ w - k))) for k in t), 0.0]
            total -= (0.5 / (grade > 0).sum() if g else 0.5 / (grade == 0).sum()) * np.log(edge[g] - edge[g + 1])
        return total

    w, t = toxicity.fit(row, place, x[row, place], grade, size, grades, steps=1500)
    best = loss(w, t)
    for i in range(size + grades - 1):
        for step in (0.02, -0.02):
            w2, t2 = w.copy(), t.copy()
            (w2 if i < size else t2)[i if i < size else i - size] += step
            assert loss(w2, t2) > best - 1e-6


def test_ordinal_fit_and_prediction():
    """One weight for all thresholds; probabilities are those of the definition."""
    draw = np.random.default_rng(1)
    value = draw.uniform(-2, 4, 3000)  # half of grade 0, so both kinds weigh as many rows
    grade = np.searchsorted([1, 2, 3], value + draw.logistic(0, 0.2, 3000))
    weights, thresholds = toxicity.fit(np.arange(3000), np.zeros(3000, int), value, grade, 1, 4, ridge=0)
    assert weights[0] > 0 and np.allclose(thresholds / weights[0], [1, 2, 3], atol=0.15)
    word = np.sort(toxicity.features(strings(pa.array(["bad"])))[2])
    model = toxicity.Ordinal(word, np.array([2.0]), np.array([1.0, 2.0, 3.0]))
    above = model.predict(strings(pa.array(["bad good BAD", "good", ""])))
    eta = 2 * np.log(3)
    assert np.allclose(above[0], 1 / (1 + np.exp(-(eta - model.thresholds))))
    assert np.allclose(above[1:], 1 / (1 + np.exp(model.thresholds)))


def test_toxicity_of_awkward_rows(spark, docs, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = toxicity.severity(docs, model)
    assert got.count() == docs.count() and got.where("severity IS NULL OR toxic").count() == 0
    assert toxicity.severity(empty, model).count() == 0
    assert toxicity.civil(docs, model).columns == docs.columns
    none = toxicity.learn(docs, labels.limit(0))
    assert toxicity.severity(docs, none).where("severity > 0.001").count() == 0


def test_a_repeated_id_teaches_once(spark):
    docs, labels = severe(spark, 300, 4)
    first = docs.where("doc_id = 40000").first()
    copies = docs.union(spark.createDataFrame([tuple(first)] * 5000, docs.schema))
    assert toxicity._sample(copies, labels, 5000).count() == 300
    one, many = toxicity.learn(docs, labels), toxicity.learn(copies, labels)
    assert (one.vocabulary == many.vocabulary).all()
    np.testing.assert_allclose(one.weights, many.weights, atol=1e-6)
    # of different texts of an id the same one is taken, and a null only if there is no other
    twice = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = {tuple(map(tuple, toxicity._sample(twice.repartition(n), marks, 9).select("toxic", "text").orderBy("toxic").collect()))
           for n in (1, 3)}
    assert len(got) == 1 and next(iter(got))[0] == (0, None) and next(iter(got))[1][1] in "ab"


# --- byte-level BPE ---------------------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)._encoding


@pytest.mark.parametrize("leaf, window", [(1, 1), (3, 2), (17, 4), (1000, 64)])
def test_any_tree_gives_the_library_ids(leaf, window):
    own = bpe.Codec(library()._mergeable_ranks, public_tokenizers.PATTERN, leaf, window)
    draw = random.Random(leaf)
    texts = ["", "a", "  ", "\n\n  x", "it's they'll we'v", "a" * 300, " " * 99 + "b", "é漢👍 x" * 9, "'" * 40, "x   y  "]
    texts += ["".join(draw.choices("ab'sré漢1 \n\t.,!", k=draw.randint(1, 200))) for _ in range(150)]
    texts += ["".join(draw.choices("  's", k=60)) for _ in range(50)]
    for t in texts:
        ids = own.encode(t)
        assert ids.tolist() == library().encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_join_is_associative():
    own = bpe.Codec(library()._mergeable_ranks, public_tokenizers.PATTERN, 8, 2)
    draw = random.Random(9)
    for _ in range(100):
        t = "".join(draw.choices("ab 's\n1é", k=60))
        a, b = sorted(draw.sample(range(1, 60), 2))
        x, y, z = own.part(t, 0, a), own.part(t, a, b), own.part(t, b, 60)
        left, right = own.join(t, own.join(t, x, y), z), own.join(t, x, own.join(t, y, z))
        assert left.ids.tolist() == right.ids.tolist() == library().encode_ordinary(t)
        assert left.ends.tolist() == right.ends.tolist()


def test_bpe_of_awkward_rows(docs, empty):
    expected = []
    for i, t in plain_rows():
        ids = library().encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    columns = ["n_tokens", "ids_sha256", "decoded_sha256"]
    got = by_id(bpe.digests(docs, RANKS, public_tokenizers.PATTERN, leaf=1000), *columns)
    assert got == sorted(expected, key=repr)
    full = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    assert [bytes(r[0]) for r in full.where("doc_id = 8").select("decoded").collect()] == [TEXTS[8].encode()]
    assert bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# --- top-k ------------------------------------------------------------------------------------------------------


def top_k_by_force(rows, asked, k):
    known = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        known[i] = min(known.get(i, v), v)
    whole = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v in known.items()}
    out = []
    for q in asked:
        if q in whole:
            # beyond a long all scores are equal
            score = {i: max(min(sum(a * b for a, b in zip(whole[q], v)), 2**63 - 1), -(2**63)) for i, v in whole.items()}
            scored = sorted((-score[i], i) for i in whole if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("shards", [1, 4])
@pytest.mark.parametrize("kind", ["normal", "sparse", "positive", "ties", "mixed"])
def test_top_k(spark, shards, kind):
    draw = np.random.default_rng(len(kind))
    n, width = 400, 12
    x = draw.normal(size=(n, width)).astype(np.float32)
    if kind == "sparse":
        x[draw.random(x.shape) < 0.8] = 0
    elif kind == "positive":
        x = np.abs(x) ** 3
    elif kind == "ties":
        x = np.round(x[:4].repeat(100, 0))
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    if kind == "mixed":
        rows += [(500, None), (501, []), (502, [1.0, None]), (503, [float("nan")] * 3), (504, [float("inf")]),
                 (600, [2.0]), (600, [1.0, 5.0]), (700, [1e30, -1e30]), (701, [-1e25, 1.0]), (None, [1.0]), (505, [0.5] * 20)]
        rows += rows[:5]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard", "2 AS kind")
    asked = list(range(0, 800, 50)) + [501, 505]
    got = topk.top_k(vectors, vectors.where(f"vec_id IN ({', '.join(map(str, asked))})"), 7, shards)
    assert sorted(map(tuple, got.collect())) == top_k_by_force(rows, asked, 7)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0


def test_top_k_prunes(monkeypatch):
    """With skewed bounds, few lists are essential and few vectors are probed to the end."""
    draw = np.random.default_rng(4)
    x = (draw.exponential(size=(5000, 30)) * np.geomspace(1000, 1, 30)).astype(np.int64)
    shard = topk.Shard(list(range(5000)), list(x))
    ids, scores = shard.search(x[7], 7, 10)
    full = x @ x[7]
    full[7] = -1
    assert sorted(scores.tolist())[-10:] == sorted(full.tolist())[-10:]
    assert len(ids) < 50


# --- WARC -------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/ü?x=1 2", "<p>" + "same " * 50), (2, "http://b", "<p>" + "same " * 50), (3, None, None), (4, "u\r\nv", ""),
    (5, "http://c", "short"), (6, "http://c", "short"), (7, "http://d", "ß" * 60), (8, "http://d", "ß" * 60),
    (None, "http://n", "<p>" + "same " * 50), (None, "http://m", "only" * 40), (None, "http://m", "only" * 40),
    (9, "http://long", LONG), (9, "http://long", LONG), (0, "http://z", LONG),
] + [(20 + i, f"http://h/{i}", f"<html><body>page {i} " + "text " * (20 + i)) for i in range(40)]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, 1, "d", b"x") for r in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, size int, digest string, payload binary")


def test_warc_round_trip(spark, pages):
    payloads = [(i, (h or "").encode()) for i, _, h in PAGES]
    least = {}
    for i, p in payloads:
        if i is not None and len(p) >= 100:
            least[p] = min(least.get(p, i), i)
    expected = [
        (i, len(p), hashlib.sha256(p).hexdigest(), *(("revisit", least[p]) if p in least and i != least[p] else ("response", None)))
        for i, p in payloads
    ]
    got = warc.archive_round_trip(pages).drop("archive", "offset")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    small = warc.write_archives(pages.repartition(2), archive_bytes=2000)
    assert small.count() > 2
    back = warc.read_archives(small).collect()
    assert sorted((r["url"] for r in back), key=repr) == sorted((u for _, u, _ in PAGES), key=repr)
    assert {bytes(r["payload"]) for r in back if r["record_type"] == "response"} == {p for _, p in payloads}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_archives_begin_with_the_dictionary(pages):
    content = bytes(warc.write_archives(pages.coalesce(1)).first()["content"])
    assert content[:4] == b"\x5d\x2a\x4d\x18"
    assert len(list(warc.records(content))) == len(PAGES)


def test_damaged_archives_are_refused(pages):
    content = bytes(warc.write_archives(pages.coalesce(1)).first()["content"])
    for bad in (content[:-1], content[:-40], b"x" + content, content[:300], content + b"xyz"):
        with pytest.raises(warc.WarcError):
            list(warc.records(bad))
    good = warc.record(1, "u", b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None)
    assert warc.parse(good)["payload"] == b"abc"
    for old, new in ((b"WARC/1.1", b"WARC/0.1"), (b"Content-Length: ", b"Content-Length: 1"), (b"abc", b"abd"),
                     (b"WARC-Date", b"WARC-Day"), (b"X-Payload-Length: 3", b"X-Payload-Length: 4"),
                     (b"WARC-Date:", b"WARC-Type:"), (b"sha256:", b"sha256:0")):
        with pytest.raises(warc.WarcError):
            warc.parse(good.replace(old, new, 1))


def foreign(kind, block, **head):
    """A record as another writer would write it."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:0f8fad5b-d9cb-469f-a165-70867728950e>",
             "WARC-Date": "2024-05-06T07:08:09Z", "Content-Length": len(block), **{k.replace("_", "-"): v for k, v in head.items()}}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers_are_read(spark):
    import base64
    import struct

    import zstandard

    http, body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n", b"<p>hello</p>" * 40
    sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    plain = [
        foreign("warcinfo", b"software: other\r\n", Content_Type="application/warc-fields"),
        foreign("response", http + body, Content_Type="application/http;msgtype=response", WARC_Payload_Digest=sha1(body),
                WARC_Block_Digest="sha256:" + hashlib.sha256(http + body).hexdigest(), WARC_Target_URI="http://a/%C3%BC"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", Content_Type="application/http; msgtype=request"),
        foreign("revisit", http, Content_Type="application/http; msgtype=response", WARC_Payload_Digest=sha1(body),
                WARC_Profile="http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                WARC_Refers_To="<urn:uuid:00000000-0000-0000-0000-000000000001>"),
        foreign("resource", body, Content_Type="text/html", WARC_Payload_Digest="blake3:zzz"),
        foreign("x-other", b""),
    ]
    packer = zstandard.ZstdCompressor(write_content_size=False)
    content = b""
    for data in plain:
        pack = packer.compressobj()  # states no size
        content += pack.compress(data) + pack.flush() + struct.pack("<II", 0x184D2A50, 3) + b"abc"
    archives = spark.createDataFrame([("a.warc.zst", bytearray(content))], "archive string, content binary")
    got = warc.read_archives(archives).orderBy("offset").collect()
    assert [r["record_type"] for r in got] == ["warcinfo", "response", "request", "revisit", "resource", "x-other"]
    assert [r["payload"] and bytes(r["payload"]) for r in got] == [b"software: other\r\n", body, b"", None, body, b""]
    assert got[1]["payload_digest"] == got[4]["payload_digest"] == hashlib.sha256(body).hexdigest()
    assert got[1]["url"] == "http://a/ü" and got[1]["payload_bytes"] == len(body) and got[3]["payload_digest"] == sha1(body)
    assert {r["page_id"] for r in got} == {None} and got[3]["refers_to_id"].endswith("000001>") and got[3]["refers_to"] is None
    for old, new in ((b"hello", b"hallo"), (sha1(body).encode(), sha1(b"").encode()), (b"WARC-Date", b"WARC-Day"), (b"sha1:", b"sha1:?")):
        with pytest.raises(warc.WarcError):
            warc.parse(plain[1].replace(old, new))


def test_many_short_pages_without_ids_do_not_meet(spark):
    pages = spark.range(400, numPartitions=4).selectExpr("CAST(NULL AS LONG) AS page_id", "CAST(NULL AS STRING) AS url", "'short' AS html")
    got = warc.read_archives(warc.write_archives(pages)).collect()
    assert len(got) == 400 and len({r["archive"] for r in got}) > 2


def test_many_documents_of_one_id_are_dealt_to_several_parts(spark):
    docs = spark.range(2000).selectExpr("CAST(7 AS LONG) AS doc_id", "concat('text ', id) AS text")
    from starloom.session import stage_table
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # or so few rows become one part
    try:
        segments = stage_table(tokenbin.write_segments(docs, WORDS, 1))
    finally:
        spark.conf.set(name, before)
    assert segments.select("part").distinct().count() > 2
    starts = sorted((r["start"], r["n_tokens"]) for r in tokenbin.read_segments(segments).collect())
    assert len(starts) == 2000 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


# --- main text --------------------------------------------------------------------------------------------------


def article(text, wrap="article", n=1):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><script>var a='<p>no</p>';</script></head><body>"
        f"<nav><ul><li><a href=/>menu</a></ul></nav><div class='ad ad-{n}'>buy this now</div><{wrap}>{text}</{wrap.split()[0]}>"
        f"<div class=sidebar>{'side text ' * 30}</div><section id='comments'><p>{'reader says ' * 40}</p></section>"
        f"<form><p>your name</p></form><div class='cookie-notice'>we use cookies</div><footer>&copy; foot</footer></body></html>"
    )


def test_main_text():
    page = html.parse(article("<h1>T&eacute;st</h1><p>a  <b>b</b>c\n d<p>e&nbsp;&amp&#x21;<br>f<!-- no --><ul><li>g<li>h</ul><style>p{}</style>"))
    assert page.text("body>article") == "Tést\na bc d\ne &! f\ng\nh"


def test_unclosed_and_broken_markup():
    page = html.parse("<body><article><p><b>One.<br><p>Two <i>and</b> more</i> <3 & <p>Three</article><div>after")
    assert page.text("body>article") == "One.\nTwo and more <3 &\nThree"
    for source in ("", "<", "<p", "<script>", "</p></div>", "<a href='x", "<![CDATA[x", "<!--", "&#0;&bogus;", "<b>" * 3000):
        html.parse(source).scores()
    assert html.parse("just text").text("body") == "just text"


def test_paths_are_voted_on(spark):
    rows = [(i, "http://www.Host.example/x", article("<p>" + f"main text {i} " * 30, f"div class='story{i}'", i)) for i in range(8)]
    # this page's side box is longer than its story
    rows.append((8, "https://host.example:80/y", article("<p>short story", "div class=story9").replace(
        "<div class=sidebar>", "<div class=box><p>" + "other things " * 50 + "</p></div><div class=sidebar>")))
    rows += [(9, "http://else", None), (10, None, ""), (11, None, "<p>words alone"), (None, "http://else", "<div><p>x</p></div>")]
    rows += [rows[0]]
    pages = spark.createDataFrame([(*r, "a", 1) for r in rows], "page_id long, url string, html string, host string, path int")
    won = {r["host"]: r["path"] for r in html.winning_paths(pages).collect()}
    assert won["host.example"] == "body>div.story#"
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["text"], r["n_chars"]) for r in html.extract(pages).collect())
    texts = {i: t for i, t, _ in got}
    assert all(texts[i] == ("main text %d " % i * 30).strip() for i in range(8))
    assert texts[8] == "short story" and texts[9] == texts[10] == "" and texts[11] == "words alone" and texts[-1] == "x"
    assert all(n == len(t) for _, t, n in got) and len(got) == len(rows)
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("tag", [
    "body style='overflow:hidden'", "div aria-hidden=\"false\"", "div data-id=ad", "div data-class='sidebar' class=story",
    "div data-href=/a?role=form title='the id = ad'", "div class=story class=ad", "div data-x='class=\"ad\"' Class = story",
])
def test_attributes_are_told_by_their_whole_name(tag):
    page = html.parse(f"<html><{tag}><p>{'the story ' * 20}</p></{tag.split()[0]}>")
    assert [b[0] for b in page.blocks] == [("the story " * 20).strip()]
    assert "sidebar" not in page.paths[-1] and "ad" not in page.paths[-1].split(".")
    assert not html.parse("<body><div hidden>x</div><div role='form'>y</div><p><b HIDDEN=hidden>z</b>").blocks


STORY = "<p>" + "the story goes on " * 30 + "</p>"


@pytest.mark.parametrize("tag", [
    "div class='elementor-widget elementor-widget-text-editor'", "div class='content has-sidebar'", "div id=share-page",
    "article class='post related'", "main class=form", "div class='layout-sidebar-left'", "section class='notice'",
])
def test_names_do_not_lose_the_container_of_the_text(tag):
    page = html.parse(f"<body><nav>menu</nav><div class=ad>buy this</div><{tag}>{STORY}</{tag.split()[0]}>"
                      "<div class=sidebar>side text</div><div class='cookie-notice'>we use cookies</div></body>")
    best = max(page.scores(), key=page.scores().get)
    assert page.text(best) == page.text("body") == ("the story goes on " * 30).strip()


def test_marks_of_parts_of_the_text():
    code = "<pre>x = 1 <span class='hljs-comment'># one</span></pre>"
    page = html.parse(f"<body><article>{STORY}{code}<div class='side share-box'>tell friends</div></article>")
    assert page.text("body>article").endswith("\nx = 1 # one")
    # a page made of widgets, none of which holds most
    widgets = "".join(f"<div class='elementor-widget elementor-widget-{n}'><p>{n} {'words ' * 20}</p></div>" for n in "abcdef")
    page = html.parse(f"<body><div class=all><div class='elementor-widget elementor-widget-h'>Title</div>{widgets}</div>")
    assert [b.split()[0] for b in page.text("body>div.all").split("\n")] == ["Title", *"abcdef"]
    # adverts and reader comments beside a short article, however long
    for box in ("div class=ad", "section id=comments"):
        page = html.parse(f"<body><article><p>{'a short story ' * 10}</p></article><{box}>{STORY * 3}</{box.split()[0]}>")
        assert page.text("body") == ("a short story " * 10).strip()
    # mostly links, or a mark that wins the vote on other pages
    page = html.parse(f"<body><div class=x>{STORY}</div><div class='box-related'><p>{'<a href=x>other story</a> ' * 99}</p></div>")
    assert page.text("body") == ("the story goes on " * 30).strip()
    page = html.parse(f"<body><div class='has sidebar-page'><p>short</p></div><div class=x>{STORY}</div>")
    assert page.text("body>div.has.sidebar-page") == "short" and "short" not in page.text("body")


@pytest.mark.parametrize("tag", ["form id=aspnetForm", "header", "aside", "form><header"])
def test_wrapped_pages_are_kept(tag):
    end = "".join(f"</{t.split()[0]}>" for t in reversed(tag.split("><")))
    page = html.parse(f"<body><nav>{STORY * 9}</nav><{tag}><div class=content><p>{STORY}</p></div>{end}<footer>{STORY * 9}</footer>")
    assert page.text(page.best()) == ("the story goes on " * 30).strip()
    # but not beside an article, nor for less than half of the text
    page = html.parse(f"<body><article><p>short</p></article><{tag}><div class=content><p>{STORY}</p></div>{end}")
    assert page.text(page.best()) == "short"
    page = html.parse(f"<body><div>{STORY * 2}</div><{tag}><p>{STORY}</p>{end}")
    assert page.text(page.best()).split("\n") == [("the story goes on " * 30).strip()] * 2


def test_a_header_inside_an_article_is_a_part_of_it():
    page = html.parse(f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>Lead</p></header><p>{STORY}</p>"
                      "<footer>Shares</footer></article>")
    assert page.text(page.best()).split("\n") == ["Title", "Lead", ("the story goes on " * 30).strip()]


def test_broken_pages_take_linear_time():
    import time

    began = time.process_time()
    for source in ("<a " * 350_000 + '"', '<a href="x>' * 90_000 + "'" * 3, "<div>" * 50_000 + "text", "<div>a" * 50_000,
                   "<div class=a><p>b" * 20_000, "<p title='" * 90_000):
        page = html.parse(source)
        best = page.best()
        assert best is None or page.text(best)
    assert time.process_time() - began < 30
    assert html.parse("<p title=\"x>text</p><p>more 'text'</p>").whole() == "text\nmore 'text'"


class PlainArticle(HTMLParser):
    """The blocks of the article element, straight from the library's events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.raw, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.raw += tag in ("script", "style")
        if tag in html.BLOCKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.raw -= tag in ("script", "style")
        if tag in html.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth and not self.raw:
            self.blocks[-1] += data


def test_given_pages_against_a_plain_version(spark):
    """Nearly every character of the article stays, and nearly none of what is around it."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    kept = total = extra = 0
    for r in html.extract(pages).collect():
        plain = PlainArticle()
        plain.feed(sources[r["page_id"]] or "")
        blocks = [b for b in (" ".join(x.split()) for x in plain.blocks) if b]
        got = Counter(r["text"].split("\n") if r["text"] else [])
        common = sum(len(b) * n for b, n in (Counter(blocks) & got).items())
        total += sum(map(len, blocks))
        kept += common
        extra += sum(len(b) * n for b, n in got.items()) - common
    print(f"article text kept {kept / total:.4f}, other text {extra / total:.4f}")
    assert kept / total > 0.99 and extra / total < 0.01


def test_headline_lead_and_sections_are_kept(spark):
    long = "<p>" + "many words of the story " * 120 + "</p>"
    sources = {
        "post": f"<body><nav>x</nav><div class=post><h1>Headline</h1><p class=lead>Lead</p><div class=body>{long}</div></div>",
        "wrap": f"<body><div class=post><h1>Headline</h1><div class=in><div class=body>{long}</div></div></div>",
        "main": f"<body><main><h1>Headline</h1><article>{long}</article></main><div class=note>stray words</div>",
        "sections": "<body><div class=content><section class=intro><p>" + "intro " * 170
                    + "</p></section><section class=details><p>" + "details " * 250 + "</p></section></div>",
        "cells": "<body><div class=text><p>" + "paragraph " * 20 + "</p><table>"
                 + f"<tr>{'<td>some cell</td>' * 9}</tr>" * 30 + "</table></div>",
        "bare": f"<h1>Headline</h1><div class=body>{long}</div>",
    }
    rows = [(10 * i + j, f"http://{host}/{j}", source) for i, (host, source) in enumerate(sources.items()) for j in range(3)]
    rows.append((90, "http://post/links", "<body><p><a href=x>first linked</a></p><p><a href=x>second</a></p>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = {r["page_id"]: r["text"].split("\n") for r in html.extract(pages).collect()}
    story = ("many words of the story " * 120).strip()
    for j in range(3):
        assert texts[j] == ["Headline", "Lead", story]
        assert texts[10 + j] == texts[20 + j] == texts[50 + j] == ["Headline", story]
        assert [b[:5] for b in texts[30 + j]] == ["intro", "detai"]
        assert texts[40 + j][0].startswith("paragraph") and texts[40 + j][1:] == ["some cell"] * 270
    assert texts[90] == ["first linked", "second"]


# --- token files ------------------------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


def word_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_words_give_the_library_ids():
    own, library_ = tokenbin.Words.from_file(WORDS, memory=50), word_library()
    draw = random.Random(1)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "é", "́", "İ", "Σ", "ß", "1", "9", ".", "!!", " ",
                "\x1c", "\x0b", "\x85", "<|endoftext|>", "<|startoftext|>", "<|end", "漢", "👍", " ", "'", "don't", "LL"]
    texts = ["", " ", *[t for t in TEXTS if t], *("".join(draw.choices(alphabet, k=draw.randint(1, 30))) for _ in range(600))]
    for begin in range(0, len(texts), 37):
        some = texts[begin : begin + 37]
        assert [x.tolist() for x in own.encode(some)] == [library_.encode(t, add_special_tokens=False).ids for t in some]


def test_words_are_cut_at_white_space_only():
    library_ = word_library()
    space = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and len(tokenbin.cut(f"a{c}b")) == 2]
    assert " " in space and "\u3000" in space and "\x1c" not in space
    ids = [library_.encode(x, add_special_tokens=False).ids for x in ("a", "b")]
    for c in space:
        assert library_.encode(f"a{c}b", add_special_tokens=False).ids == ids[0] + ids[1]


def test_segment_access():
    draw = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (3, 256), (2000, 60_000), (700, 1 << 40), (512, 255), (1024, 256)):
        ids = draw.integers(0, top, n, dtype=np.uint64)
        ids[: n // 2] //= np.uint64(300)
        content = tokenbin.encode_segment([5, None], [n // 2, n - n // 2], ids)
        segment = tokenbin.Segment(content)
        assert segment.ids().tolist() == ids.tolist() and segment.doc_ids == [5, None]
        assert [segment[i] for i in range(n)] == ids.tolist()
        assert segment.starts.tolist() == [0, n // 2, n]
        for bad in (content[:-1], content + b"x", b"DAC0" + content[4:], content[:10]):
            with pytest.raises(ValueError):
                tokenbin.Segment(bad)


def test_token_files(spark, docs, empty):
    library_ = word_library()
    rows = sorted(plain_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    start, expected = 0, []
    for i, t in rows:
        ids = [*library_.encode(t or "", add_special_tokens=False).ids, 1]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = tokenbin.token_files(docs, WORDS, 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    from starloom.session import stage_table
    small = tokenbin.read_segments(stage_table(tokenbin.write_segments(docs, WORDS, 1, segment_ids=50)))
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(expected, key=repr)
    assert tokenbin.token_files(empty, WORDS, 1).count() == 0


# --- token counts -----------------------------------------------------------------------------------------------

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("chunk, overlap", [(8, 2), (20, 3), (64, 16), (500, 40)])
def test_chunks_give_the_library_counts(chunk, overlap):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = tokencount.Counter(PIECES, chunk, overlap)
    assert own.safe
    draw = random.Random(chunk)
    alphabet = ["a", "b", "the", " ", " ", "  ", "\n", "▁", "é", "漢", "👍", "ｆ", "<s>", "</s>", "<unk>", "1", ".", " ", "ing"]
    texts = [t[:3000] for t in TEXTS if t] + ["漢 " * 50, " " * 200, "▁" * 90, "a▁ b" * 60, "\U0001f468 x" * 40]
    texts += ["".join(draw.choices(alphabet, k=draw.randint(1, 150))) for _ in range(200)]
    assert own.count(texts) == [len(whole.encode(t)) for t in texts]
    assert own.widened > 0


def test_texts_without_spaces_are_counted_in_linear_time():
    import time

    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = tokencount.counter(PIECES)
    draw = random.Random(6)
    for alphabet in ("漢字日本語中文", "\n", "ab\t", "\u3000あ"):
        text = "".join(draw.choices(alphabet, k=300_000))
        for t in (text, "a few words " * 9000 + text + " and words" * 9000 + text):
            began = time.process_time()
            n = len(whole.encode(t))
            library_time, began = time.process_time() - began, time.process_time()
            assert own.count([t]) == [n]
            assert time.process_time() - began < 20 * library_time + 2
    small = tokencount.Counter(PIECES, 50, 8)
    for _ in range(200):
        t = " ".join("".join(draw.choices("漢a字\n", k=draw.choice([1, 3, 200]))) for _ in range(draw.randint(1, 9)))
        assert small.count([t]) == [len(whole.encode(t))]


def test_token_counts(docs, empty):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for i, t in plain_rows():
        n = len(whole.encode(t or ""))
        expected.append((i, len((t or "").encode()), n, n > 4096))
    got = tokencount.token_counts(docs, PIECES, chunk=1000, overlap=50)
    assert by_id(got, "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert tokencount.token_counts(empty, PIECES).count() == 0
