import datetime as dt

import pytest
from banking import RUN, sources
from pyspark.sql import functions as F

from starloom.plans.warehouse import Warehouse
from starloom.session import new_path


@pytest.fixture(scope="module")
def loaded(spark):
    warehouse = Warehouse(
        spark, new_path(spark, "warehouse"), "Source", (dt.date(1995, 1, 1), dt.date(1998, 12, 31)))
    found = sources(spark)
    reports = warehouse.run(found, RUN)
    return warehouse, {k: v.collect() for k, v in reports.items()}


def test_reports(loaded):
    _, reports = loaded
    status = {r.ValidationCheck: r.ValidationStatus for r in reports["row_counts"]}
    assert status["Client transformation"] == "PASS" and status["Loan fact loading"] == "FAIL"
    assert all(r.InvalidRows == 0 for r in reports["integrity"])
    assert {r.ValidationCheck: r.ValidationStatus for r in reports["reconciliation"]} == {
        "Transaction data mart": "PASS", "Loan data mart": "FAIL", "Problem-loan data mart": "FAIL"}
    assert reports["excluded_loans"][0].ExcludedLoans == 3
    assert all(r.Status == "PASS" for r in reports["rules"])


def test_second_run_adds_nothing(spark, loaded, rows):
    warehouse, _ = loaded
    before = {n: rows(warehouse.read("fact", n)) for n in ("FactLoan", "FactTransaction")}
    accounts = rows(warehouse.read("dim", "DimAccount"))
    warehouse.run(sources(spark), RUN)
    for name, old in before.items():
        assert rows(warehouse.read("fact", name)) == old
    assert rows(warehouse.read("dim", "DimAccount")) == accounts
    assert warehouse.actions["DimAccount"].first().asDict() == {
        "UpdatedRows": 7, "InsertedRows": 0, "KeptRows": 1}
    assert warehouse.actions["FactLoan"].first()["InsertedRows"] == 0


def test_invariants(loaded):
    warehouse, _ = loaded
    fact = warehouse.read("fact", "FactTransaction")
    assert fact.filter("InflowAmount - OutflowAmount <> SignedAmount").isEmpty()
    mart = warehouse.read("mart", "MonthlyTransactionPerformance")
    assert mart.agg(F.sum("NetCashFlow")).first()[0] == fact.agg(F.sum("SignedAmount")).first()[0]
    keys = [r.TransactionKey for r in fact.select("TransactionKey").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
