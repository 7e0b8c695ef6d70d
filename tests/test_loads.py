"""What a load must not do: lose facts, double rows, read its joins twice, or show half an append."""

import datetime as dt
import importlib

import pytest
from pyspark.sql import functions as F

from starloom import operators as O
from starloom import schemas as S
from starloom.operators import LoadGateError, joins
from starloom.plans import dims, facts
from starloom.session import byte_size, known_size, new_path, stage_table
from starloom.sources import PublishError, SnapshotTable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def jobs(spark):
    """Jobs that a function runs."""

    def count(function):
        group, tracker = "counted", spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(group, group)
        before = len(tracker.getJobIdsForGroup(group))
        function()
        found = len(tracker.getJobIdsForGroup(group)) - before
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    return count


# --- size checks and column order ---


def test_size_check_moves_no_rows(spark):
    wide = spark.range(1000, numPartitions=20).withColumn("t", F.lit("x" * 1000))
    assert joins.fits_broadcast(wide) and not joins.fits_broadcast(wide, max_bytes=100_000)
    assert not joins.fits_broadcast(wide, max_rows=999)
    checked = plan(wide.agg(F.count("*"), byte_size(wide)))
    assert "Limit" not in checked and checked.count("partial_count") == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_columns_do_not_depend_on_the_size(spark, monkeypatch, how):
    fact = spark.range(300).select("id", F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("k"), F.lit(1).alias("x"))
    dim = spark.range(250).select((F.col("id") * 2).alias("v"), F.col("id").alias("k"))
    found = [joins.lookup_join(fact, dim, "k", how, "id", fits=True)]
    found.append(joins.lookup_join(fact, dim, "k", how, "id", fits=False))
    found.append(joins.lookup_join(fact, dim, "k", how, "id", fits=False, slice_rows=50))
    assert [f.columns for f in found] == [["id", "k", "x", "v"]] * 3
    assert len({tuple(sorted(map(repr, f.collect()))) for f in found}) == 1


def test_checks_are_one_scan_and_one_exchange(spark, rows):
    fact = stage_table(spark.range(1000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") > 2, F.col("id") % 90).alias("b")))
    seven, few = stage_table(spark.range(6).toDF("k")), stage_table(spark.range(5, 500).toDF("k"))
    report = O.check_rules(
        fact, not_null=["b"], unique=["id", "b"], at_least={"a": 1},
        references=[O.Reference("a gone", "a", seven, "k"), O.Reference("b gone", "b", few, "k"),
                    O.Reference("a few", "a", few, "k"), O.Reference("id gone", "id", few, "k")])
    assert {r["Rule"]: r["Violations"] for r in report.collect()} == {
        "b not null": 3, "a >= 1": 143, "id unique": 0, "b unique": 907, "a gone": 142,
        "b gone": sum(i <= 2 or i % 90 < 5 for i in range(1000)), "a few": sum(i % 7 < 5 for i in range(1000)),
        "id gone": 505}
    text = plan(report).split("Initial Plan")[-1]
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert text.count("FileScan") == 3


def test_a_dimension_with_a_key_twice_is_refused(spark):
    dim = spark.createDataFrame([(1, 10), (1, 11), (None, 0), (None, 0)], "id long, key long")
    with pytest.raises(LoadGateError, match="duplicate keys"):
        O.resolve_once(spark.range(3), [O.KeyLookup(dim, "id", "id", "key")], "id")


def test_a_stage_table_knows_its_size(spark):
    stored = stage_table(spark.range(10).select(F.lit("abc").alias("t")))
    assert known_size(stored) == (10, 10 * 16 + 30) and known_size(spark.range(1)) is None
    assert known_size(stage_table(spark.range(0))) == (0, 0)
    assert joins.fits_broadcast(stored) and not joins.fits_broadcast(stored, max_rows=9)


# --- one join per load ---


def test_the_star_join_runs_once(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        reads.add(1)
        return x

    fact = stage_table(spark.range(50)).select(seen("id").alias("id"))
    dim = spark.range(40).select("id", (F.col("id") + 1).alias("key"))
    rows, unmatched = O.resolve_once(fact, [O.KeyLookup(dim, "id", "id", "key", on_missing="drop")], "id")
    assert rows.count() == 40 and unmatched.first()["UnmatchedRows"] == 10
    assert O.assign_keys(rows, "id", "n", stored=True).agg(F.max("n")).first()[0] == 40
    assert reads.value == 50


# --- calendar ---


def test_calendar_holds_every_date(spark):
    frame = spark.createDataFrame([(dt.date(1899, 5, 1),), (None,), (dt.date(2101, 2, 3),)], "d date")
    assert dims.calendar_range([(frame, "d")]) == (dt.date(1899, 1, 1), dt.date(2101, 12, 31))
    assert dims.calendar_range([(frame.limit(0), "d")]) == (dt.date(1900, 1, 1), dt.date(1900, 12, 31))
    long = dims.dim_date(spark, dt.date(1, 1, 1), dt.date(9999, 12, 31))
    assert long.count() == 3652059 and long.rdd.getNumPartitions() > 1


# --- appends ---


def test_an_id_twice_in_a_batch_counts_once(spark, rows):
    new = dims.new_dimensions(spark)
    known = {**new, "DimDate": dims.dim_date(spark)}
    one = [1, 5, -1, 19970101, "UNKNOWN", "UNKNOWN", 1]
    batch = spark.createDataFrame(
        [one, one, [2, *one[1:]], [None, *one[1:]]],
        "TransactionID long, AccountID long, DistrictID int, DateKey int, TransactionTypeCode string, "
        "OperationCode string, TransactionCount int",
    ).select("*", *[
        F.lit(1).cast("decimal(18,2)").alias(c)
        for c in ("TransactionAmount", "InflowAmount", "OutflowAmount", "SignedAmount", "BalanceAfterTransaction")
    ])
    load = facts.append_transactions(spark.createDataFrame([], S.FACT_TRANSACTION), batch, known)
    assert rows(load.rows, "TransactionKey", "TransactionID") == [(1, 1), (2, 2)]
    table = SnapshotTable(spark, new_path(spark, "f"), [facts.YEAR], "TransactionKey")
    table.publish(facts.with_year(load.rows))
    assert (table.rows(), table.top()) == (2, 2)
    more = batch.union(batch.withColumn("TransactionID", F.col("TransactionID") + 10))
    again = facts.append_transactions(table.read(), more, known, increment=True, last_key=table.top())
    assert rows(again.rows, "TransactionKey", "TransactionID") == [(3, 11), (4, 12)]
    assert table.append(facts.with_year(again.rows)) == 2 and (table.rows(), table.top()) == (4, 4)


@pytest.mark.parametrize("increment", [False, True])
def test_a_known_id_with_a_date_of_another_year_is_left_out(spark, rows, increment):
    known = {**dims.new_dimensions(spark), "DimDate": dims.dim_date(spark)}
    old = spark.createDataFrame(
        [(i, 5, -1, 19970101, "UNKNOWN", "UNKNOWN", 1) for i in (1, 2)],
        "TransactionID long, AccountID long, DistrictID int, DateKey int, TransactionTypeCode string, "
        "OperationCode string, TransactionCount int",
    ).select("*", *[
        F.lit(1).cast("decimal(18,2)").alias(c)
        for c in ("TransactionAmount", "InflowAmount", "OutflowAmount", "SignedAmount", "BalanceAfterTransaction")
    ])
    table = SnapshotTable(spark, new_path(spark, "f"), [facts.YEAR], "TransactionKey")
    empty = spark.createDataFrame([], S.FACT_TRANSACTION)
    table.publish(facts.with_year(facts.append_transactions(empty, old, known).rows))
    moved = old.withColumn("DateKey", F.lit(19980101)).where("TransactionID = 2")
    batch = moved.union(moved.withColumn("TransactionID", F.lit(3).cast("long")))
    load = facts.append_transactions(table.read(), batch, known, increment=increment, last_key=table.top())
    assert rows(load.rows, "TransactionKey", "TransactionID") == [(3, 3)]


def test_increments_read_the_years_of_the_batch(spark):
    table = SnapshotTable(spark, new_path(spark, "f"), ["y"])
    table.publish(spark.range(10).withColumn("y", (F.col("id") % 3).cast("int")))
    known = table.read().filter(F.col("y").isin([1]))
    fresh = O.new_rows(spark.range(4), known, "id", increment=True)
    assert "PartitionFilters: [isnotnull(y" in plan(known) or "PartitionFilters: [y" in plan(known)
    assert sorted(r[0] for r in fresh.collect()) == [0, 2, 3]


def test_a_failed_append_leaves_the_table_as_it_was(spark, rows):
    table = SnapshotTable(spark, new_path(spark, "t"))
    table.publish(spark.range(3))

    @F.udf("long")
    def broken(x):
        raise ValueError(x)

    with pytest.raises(Exception, match="ValueError"):
        table.append(spark.range(5).select(broken("id").alias("id")))
    with pytest.raises(PublishError, match="columns"):
        table.append(spark.range(5).select(F.col("id").alias("other")))
    with pytest.raises(PublishError, match="columns"):
        table.append(spark.range(5).select(F.col("id").cast("int").alias("id")))
    assert rows(table.read()) == [(0,), (1,), (2,)] and table.rows() == 3
    reader = table.read()
    assert table.append(spark.range(3, 5)) == 2 and table.append(spark.range(0)) == 0
    assert reader.count() == 3 and table.read().count() == table.rows() == 5
    assert table.versions().count() == 2


def test_cards_twice_in_one_delivery(spark, rows):
    cards = spark.createDataFrame([(1, 1, "a", "930101 08:00:00")] * 2, "card_id long, disp_id long, type string, issued string")
    none = dims.card_rows(cards.limit(0))
    assert dims.load_cards(none, cards).count() == 1


# --- upsert ---


def test_short_and_long_targets_give_the_same(spark, rows, monkeypatch):
    module = importlib.import_module("starloom.operators.upsert")
    target = spark.createDataFrame([(0, -1, "u", True), (1, 5, "a", True), (2, 6, "b", False)], "k long, id long, v string, cur boolean")
    source = spark.createDataFrame([(5, "x"), (6, "y"), (7, "z"), (-1, "w")], "id long, v string")
    found = []
    for bound in (1000, 0):
        monkeypatch.setattr(module, "SHORT_ROWS", bound)
        result = O.upsert(target, source, "id", ["v"], "k", protect=F.col("id") == -1, scope=F.col("cur"))
        found.append(rows(result, "k", "id", "v", "cur", "_action"))
    assert found[0] == found[1]
    assert found[0] == sorted(
        [(0, -1, "u", True, "kept"), (1, 5, "x", True, "updated"), (2, 6, "b", False, "kept"),
         (3, 6, "y", None, "inserted"), (4, 7, "z", None, "inserted")], key=repr)


def test_short_sides_are_upserted_without_a_join(spark, rows, jobs):
    from starloom.session import local_rows

    target = local_rows(
        spark, [(0, "U", "u", 1), (4, "b", "x", 2), (5, None, "n", 3)], S.T.StructType.fromDDL("k int, c string, v string, w long"))
    data = [("b", "y"), ("é", "e"), ("z", None), (None, "n"), ("A", "a")]
    schema = S.T.StructType.fromDDL("c string, v string")
    found = [rows(O.upsert(target, source, "c", ["v"], "k", check_source=False))
             for source in (local_rows(spark, data, schema), spark.createDataFrame(data, schema))]
    assert found[0] == found[1] and (9, "é", "e", None, "inserted") in found[0]
    few = local_rows(spark, [r for r in data if r[0]], schema)
    assert jobs(lambda: O.upsert(target, few, "c", ["v"], "k", check_source=False)) <= 1


def test_constant_lookups_write_nothing(spark, jobs, monkeypatch):
    module, keys = (importlib.import_module(f"starloom.operators.{m}") for m in ("upsert", "keys"))

    def refuse(*a):
        raise AssertionError("written")

    monkeypatch.setattr(module, "stage_table", refuse)
    monkeypatch.setattr(keys, "stage_table", refuse)
    empty = dims.new_dimensions(spark)["DimOperation"]
    made = []
    n = jobs(lambda: made.append(dims.load_lookup(empty, dims.operation_values(spark), "OperationCode", "OperationKey")))
    assert made[0].count() == 6 and n <= 2
