import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom import operators as O
from starloom.operators import joins, keys
from starloom.operators.upsert import ACTION

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# --- one row per key ---


def test_latest_breaks_ties_by_the_other_columns(spark, rows):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "n"), (2, 1, "m"), (None, 9, "x")]
    df = spark.createDataFrame(data, "id int, ts int, v string")
    expected = [(1, 5, "a"), (2, 1, "m")]
    assert rows(O.latest_per_key(df, "id", "ts")) == expected
    assert rows(O.latest_per_key(df.repartition(7), "id", "ts")) == expected


def test_latest_of_a_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(50_000).select((F.col("id") % 3 * F.col("id")).alias("k"), "id")
    latest = O.latest_per_key(df, "k", "id")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.filter("k = 0").first()["id"] == 49_998


def test_preferred_keeps_the_first_in_order(spark, rows):
    df = spark.createDataFrame([(1, "x", 1), (1, "o", 3), (1, "o", 2)], "c int, t string, d int")
    first = F.when(F.col("t") == "o", 1).otherwise(2)
    assert rows(O.preferred_per_key(df, "c", [first, "d"])) == [(1, "o", 2)]


# --- joins ---


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_sliced_without_changing_the_result(spark, rows, monkeypatch, how):
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a: False)
    fact = spark.range(3000).select(
        "id",
        F.when(F.col("id") < 1000, 7).when(F.col("id") < 2000, None).otherwise(F.col("id")).alias("k"),
    )
    dim = spark.range(0, 2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = joins.hot_keys(fact, "k", slice_rows=100)
    assert {r["_hot"] for r in hot.collect()} == {7, None}
    sliced = joins.lookup_join(fact, dim, "k", how, "id", slice_rows=100)
    assert "_salt" in sliced._jdf.queryExecution().optimizedPlan().toString()
    assert rows(sliced, "id", "k", "v") == rows(fact.join(dim, "k", how), "id", "k", "v")


def test_hot_keys_may_be_measured_elsewhere(spark, rows, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a: False)
    fact = spark.range(900).select("id", F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    stored = spark.range(2000).select((F.col("id") % 2 + 6).alias("k"))
    sliced = joins.lookup_join(fact, dim, "k", "inner", "id", measure=stored, slice_rows=100)
    assert "_salt" in sliced._jdf.queryExecution().optimizedPlan().toString()
    assert rows(sliced, "id", "k", "v") == rows(fact.join(dim, "k"), "id", "k", "v")


def test_lookups_of_large_dimensions_with_a_hot_key(spark, rows, monkeypatch):
    from starloom.operators import lookup

    monkeypatch.setattr(joins, "SLICE_ROWS", 50)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a: False)
    fact = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("acc"))
    dim = spark.range(-10, 500).select(F.col("id").alias("AccID"), (F.col("id") + 100).alias("AccKey"))
    look = O.KeyLookup(dim, "acc", "AccID", "AccKey")
    expected = sorted(((i, 95 if i % 3 == 0 else (i + 100 if i < 500 else 0)) for i in range(600)), key=repr)
    assert rows(O.resolve_keys(fact, [look], "id"), "id", "AccKey") == expected


def test_no_hot_keys_in_an_even_table(spark):
    assert joins.hot_keys(spark.range(5000).withColumn("k", F.col("id")), "k", 100) is None


def test_size_check(spark):
    assert joins.fits_broadcast(spark.range(10), 10)
    assert not joins.fits_broadcast(spark.range(11), 10)


# --- keys ---


@FEW
@given(ids=st.sets(st.integers(-10**12, 10**12), min_size=0, max_size=60), start=st.integers(1, 50))
def test_keys_are_dense_and_ordered_both_ways(spark, ids, start):
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    expected = {i: start + n for n, i in enumerate(sorted(ids))}
    for bound in (None, len(ids)):
        keyed = O.assign_keys(df, "id", "k", start, max_rows=bound)
        assert {r["id"]: r["k"] for r in keyed.collect()} == expected


def test_keys_over_many_partitions(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = O.assign_keys(df, "h", "k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = sorted(keyed, key=lambda r: r["h"])
    assert [r["k"] for r in ordered] == list(range(1, 20_001))


# --- upsert ---

DIM = "Key int, ID int, V string, Note string"


def dim(spark, data):
    return spark.createDataFrame(data, DIM)


def test_upsert_updates_inserts_and_protects(spark, rows):
    target = dim(spark, [(0, -1, "unknown", "u"), (1, 10, "old", "n"), (4, 20, "same", "m")])
    source = spark.createDataFrame([(-1, "junk"), (10, "new"), (30, "c"), (25, "b")], "ID int, V string")
    result = O.upsert(target, source, "ID", ["V"], "Key", protect=F.col("ID") == -1)
    assert rows(result) == sorted(
        [(0, -1, "unknown", "u", "kept"), (1, 10, "new", "n", "updated"),
         (4, 20, "same", "m", "kept"), (5, 25, "b", None, "inserted"), (6, 30, "c", None, "inserted")],
        key=repr,
    )
    counts = O.action_counts(result).first()
    assert tuple(counts) == (1, 2, 2)


def test_upsert_again_changes_nothing(spark, rows):
    target = dim(spark, [(0, -1, "unknown", None)])
    source = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, V string")
    first = O.upsert(target, source, "ID", ["V"], "Key").drop(ACTION)
    second = O.upsert(first, source, "ID", ["V"], "Key")
    assert rows(second.drop(ACTION)) == rows(first)
    assert O.action_counts(second).first()["InsertedRows"] == 0


def test_upsert_refuses_duplicate_source_keys(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b")], "ID int, V string")
    with pytest.raises(O.LoadGateError, match="duplicate"):
        O.upsert(dim(spark, []), source, "ID", ["V"], "Key")
    with pytest.raises(O.LoadGateError, match="duplicate"):
        O.insert_new(dim(spark, []), source, "ID", "Key")


@FEW
@given(
    old=st.dictionaries(st.integers(0, 12), st.text("ab", max_size=2), max_size=8),
    new=st.dictionaries(st.integers(0, 12), st.text("xy", max_size=2), max_size=8),
)
def test_upsert_matches_a_dictionary_update(spark, old, new):
    target = dim(spark, [(k + 1, i, v, None) for k, (i, v) in enumerate(sorted(old.items()))])
    source = spark.createDataFrame(list(new.items()), "ID int, V string")
    result = O.upsert(target, source, "ID", ["V"], "Key").collect()
    assert {r["ID"]: r["V"] for r in result} == {**old, **new}
    used = [r["Key"] for r in result]
    assert sorted(used) == list(range(1, len(used) + 1))
    assert Counter(r[ACTION] for r in result)["inserted"] == len(set(new) - set(old))


def test_upsert_current_leaves_history_alone(spark, rows):
    schema = "Key int, ID int, V string, EffectiveFrom date, EffectiveTo date, IsCurrent boolean"
    past, end, day = dt.date(1990, 1, 1), dt.date(9999, 12, 31), dt.date(1995, 5, 5)
    target = spark.createDataFrame(
        [(1, 10, "a", past, dt.date(1994, 1, 1), False), (2, 10, "b", past, end, True),
         (9, 11, "c", past, dt.date(1994, 1, 1), False)], schema)
    source = spark.createDataFrame([(10, "B"), (11, "C")], "ID int, V string")
    result = O.upsert_current(target, source, "ID", ["V"], "Key", effective_from=day)
    assert rows(result) == sorted(
        [(1, 10, "a", past, dt.date(1994, 1, 1), False, "kept"), (2, 10, "B", past, end, True, "updated"),
         (9, 11, "c", past, dt.date(1994, 1, 1), False, "kept"), (10, 11, "C", day, end, True, "inserted")],
        key=repr,
    )


def test_unknown_member_is_restored_once(spark, rows):
    row = {"ID": -1, "V": "Unknown"}
    once = O.ensure_unknown(dim(spark, [(1, 1, "a", None)]), "Key", row)
    assert rows(O.ensure_unknown(once, "Key", row)) == [(0, -1, "Unknown", None), (1, 1, "a", None)]


@pytest.mark.parametrize("increment", [False, True])
def test_new_rows(spark, rows, increment):
    source = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    target = spark.createDataFrame([(2,), (5,), (None,)], "id int")
    assert rows(O.new_rows(source, target, "id", increment)) == [(1,), (3,), (None,)]


# --- lookups ---


def test_lookup_drops_or_points_at_unknown(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, code string")
    codes = spark.createDataFrame([("a", 5, True)], "Code string, CodeKey int, Flag boolean")

    def look(on_missing):
        return O.KeyLookup(codes, "code", "Code", "CodeKey", on_missing=on_missing, carry=["Flag"])

    assert rows(O.resolve_keys(fact, [look("drop")], "id"), "id", "CodeKey") == [(1, 5)]
    assert rows(O.resolve_keys(fact, [look("unknown")], "id"), "id", "CodeKey", "Flag") == [
        (1, 5, True), (2, 0, None), (3, 0, None)]
    assert rows(O.unmatched_rows(fact, [look("unknown")], "id")) == [("CodeKey", "unknown", 2)]
    with pytest.raises(ValueError):
        look("ignore")


# --- checks ---


def test_null_equals_null_fails(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(O.pass_fail(F.col("a"), F.col("b"))).collect()] == ["PASS", "FAIL", "FAIL"]


def test_require_raises_only_on_rows(spark):
    O.require(spark.range(0), "empty")
    with pytest.raises(O.LoadGateError, match="there are rows"):
        O.require(spark.range(1), "there are rows")


def test_broken_references_one_pass(spark, rows):
    fact = spark.createDataFrame([(1, 1, 1), (2, 9, 1), (None, 1, 2), (2, 2, None)], "a int, b int, c int")
    two = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    refs = [O.Reference(f"no {x}", x, two, "k") for x in "abc"]
    assert rows(O.broken_references(fact, refs)) == [("no a", 1), ("no b", 1), ("no c", 1)]
    empty = fact.filter("a > 5")
    assert rows(O.broken_references(empty, refs)) == [("no a", 0), ("no b", 0), ("no c", 0)]


def test_orphans_of_a_hot_value_are_counted_before_the_shuffle(spark):
    fact = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("k"))
    assert O.orphan_count(fact, "k", spark.range(10_000), "id").first()[0] == 3334


def test_rules(spark):
    df = spark.createDataFrame([(1, "A", -1), (1, "B", 5), (None, None, None)], "id int, c string, n int")
    report = O.check_rules(
        df, not_null=["id"], unique=["id"], allowed={"c": ["A"]}, at_least={"n": 0}, table="t")
    assert {r["Rule"]: (r["Violations"], r["Status"]) for r in report.collect()} == {
        "t: id not null": (1, "FAIL"), "t: id unique": (1, "FAIL"),
        "t: c in list": (1, "FAIL"), "t: n >= 0": (1, "FAIL")}


def test_counts_match_counts_each_table_once(spark, rows):
    tables = {"a": spark.range(3), "b": spark.range(3), "c": spark.range(2)}
    report = O.counts_match(tables, [("a to b", "a", "b"), ("b to c", "b", "c")])
    assert rows(report) == [("a to b", 3, 3, "PASS"), ("b to c", 3, 2, "FAIL")]


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, " "), (1, None), (None, "x"), (2, "x")], "id int, t string")
    assert rows(O.value_frequency(df, "id")) == [(1, 2), (2, 1), (None, 1)]
    assert rows(O.duplicate_keys(df, "id")) == [(1, 2)]
    assert rows(O.missing_profile(df, {"id": "i"}, {"t": "t"}, rows="n")) == [(4, 1, 2)]
    assert rows(O.count_where(df, {"big": F.col("id") > 1})) == [(1,)]
    assert rows(O.control_totals(df, {"id": "s"}, "n", distinct={"id": "d"})) == [(4, 2, 4)]
