"""What must not grow with the input: rows sorted or written once more than a step needs."""

import datetime as dt
import importlib

import pytest
from banking import staged
from pyspark.sql import functions as F

from starloom import operators as O
from starloom import schemas as S
from starloom.plans import clean, dims, facts
from starloom.session import is_one_per, new_path, rows_of, stage_table


@pytest.fixture(scope="module")
def cleaned(spark):
    stg = staged(spark)
    accounts = stage_table(clean.account_clean(stg["account"], "Source"))
    return accounts, stage_table(clean.transaction_clean(stg["trans"], accounts))


def test_accounts_that_may_repeat_promise_nothing(spark, cleaned):
    accounts, transactions = cleaned
    assert is_one_per(transactions, "TransactionID")
    twice = clean.transaction_clean(staged(spark)["trans"], accounts.union(accounts))
    assert not is_one_per(twice, "TransactionID")


def test_clean_transactions_are_not_sorted_out_again(spark, cleaned, rows, monkeypatch):
    _, transactions = cleaned
    known = {**dims.new_dimensions(spark), "DimDate": dims.dim_date(spark, dt.date(1990, 1, 1), dt.date(2005, 12, 31))}
    empty = spark.createDataFrame([], S.FACT_TRANSACTION)
    as_before = rows(facts.append_transactions(empty, transactions.select("*"), known).rows)

    written = []
    monkeypatch.setattr(facts, "preferred_per_key", lambda *_: pytest.fail("one row per id already"))
    monkeypatch.setattr(facts, "stage_table", lambda df, name="stage": written.append(name) or stage_table(df, name))
    assert rows(facts.append_transactions(empty, transactions, known).rows) == as_before
    table = facts.transaction_table(spark, new_path(spark, "f"))
    for part in (transactions.where("TransactionID % 2 = 0"), transactions, transactions):
        part = rows_of(transactions, part)
        load = facts.append_transactions(table, part, known)
        table.append(facts.with_year(load.rows), table.version(), spread=False)
    ids = [r[1] for r in as_before]
    even = [i for i in ids if i % 2 == 0]
    assert rows(table.read(), "TransactionID", "TransactionKey") == sorted(
        (i, n) for n, i in enumerate(even + [i for i in ids if i % 2], 1))
    assert written == []


def test_new_keys_are_found_without_the_other_columns(spark, rows, monkeypatch):
    module = importlib.import_module("starloom.operators.upsert")
    source = stage_table(spark.range(20).select("id", F.lit("x").alias("t")))
    for known, found in ((range(0), range(20)), (range(20), ()), (range(5, 30), range(5))):
        target = spark.createDataFrame([(i,) for i in known], "id long")
        for few in (True, False):
            monkeypatch.setattr(module, "fits_broadcast", lambda _, few=few: few)
            new, n = O.new_rows_by_key(source, target, "id", 20)
            assert (rows(new), n) == ([(i, "x") for i in sorted(found, key=lambda i: repr((i, "x")))], len(found))


def test_rules_are_counted_by_numbers(spark):
    fact = stage_table(spark.range(1000).select("id", (F.col("id") % 7).cast("int").alias("a"), F.lit("b").alias("t")))
    some = stage_table(spark.range(6).toDF("k"))
    report = O.check_rules(fact, not_null=["id", "t"], unique=["id"], allowed={"t": ["c"]}, at_least={"a": 2},
                           references=[O.Reference("a gone", "a", some, "k")])
    text = report._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in text and "as string" not in text
    assert {r["Rule"]: r["Violations"] for r in report.collect()} == {
        "id not null": 0, "t not null": 0, "t in list": 1000, "a >= 2": 286, "id unique": 0, "a gone": 142}


def test_rules_beyond_one_number_and_on_texts(spark):
    fact = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), ("7", None)], "t string, n int")
    report = O.check_rules(fact, not_null=["t", "n"], unique=["t", "n"], at_least={"n": 2},
                           allowed={"n": [1]}, references=[O.Reference("t gone", "t", spark.range(8).toDF("k"), "k")])
    assert {r["Rule"]: r["Violations"] for r in report.collect()} == {
        "t not null": 1, "n not null": 1, "n in list": 2, "n >= 2": 1, "t unique": 1, "n unique": 0, "t gone": 3}
    many = O.checks._checked(fact, [(f"r{i}", f"n = {i % 4}") for i in range(130)], [], [])
    assert {r[0]: r[1] for r in many.collect()} == {f"r{i}": int(i % 4 > 0) for i in range(130)}


def test_hot_keys_are_found_without_an_exchange_per_key(spark, rows, monkeypatch):
    fact = stage_table(spark.range(3000).select(
        F.when(F.col("id") < 900, 7).when(F.col("id") < 1500, None).otherwise(F.col("id")).alias("k")))
    whole = type(fact).groupBy
    monkeypatch.setattr(type(fact), "groupBy", lambda df, *keys: pytest.fail("a row per key") if keys else whole(df))
    for kind, seven in (("long", 7), ("string", "7")):
        hot = O.joins.hot_keys(fact.select(F.col("k").cast(kind).alias("k")), "k", slice_rows=400)
        assert rows(hot) == sorted([(seven, 3), (None, 2)], key=repr)
    assert O.joins.hot_keys(spark.range(3000), "id", slice_rows=400) is None


def test_loans_are_written_once_with_the_columns_of_the_fact(spark, rows, monkeypatch):
    stg = staged(spark)
    accounts = stage_table(clean.account_clean(stg["account"], "Source"))
    loans = stage_table(clean.loan_clean(stg["loan"], accounts))
    known = {**dims.new_dimensions(spark), "DimDate": dims.dim_date(spark, dt.date(1990, 1, 1), dt.date(2005, 12, 31))}
    module, written = importlib.import_module("starloom.operators.lookup"), []
    monkeypatch.setattr(module, "stage_table", lambda df, name="stage": written.append(df.columns) or stage_table(df, name))
    load = facts.resolve_loans(loans, known)
    assert len(written) == 1 and not {"LoanStatusDescription", "LoanStatusGroup", "LoanDate"} & set(written[0])
    assert load.rows.columns == [c for c in facts.LOAN_COLUMNS if c != "LoanKey"]
    dated = loans.where("LoanDateKey >= 19900101")
    assert rows(load.rows, "LoanID", "LoanAmount", "LoanDateKey") == rows(dated, "LoanID", "LoanAmount", "LoanDateKey")


def test_loan_fact_of_an_empty_table_is_not_written_again(spark, monkeypatch):
    from catalogue import bank as module

    bank = module.Bank(spark, "/root/testdata/sf0.001")
    bank.loan_clean, bank.loan_dims  # what comes before
    monkeypatch.setattr(module, "stage_table", lambda *_: pytest.fail("written again"))
    keys = [r[0] for r in bank.fact_loan.select("LoanKey").orderBy("LoanID").collect()]
    assert keys == list(range(1, bank.loan_clean.count() + 1))
