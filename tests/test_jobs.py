import datetime as dt
from decimal import Decimal as D

import pytest
from banking import LOAN, RUN, d, sources, staged
from pyspark.sql import functions as F

from starloom import constants as K
from starloom import schemas as S
from starloom.operators import LoadGateError
from starloom.operators.upsert import ACTION
from starloom.plans import clean, dims, facts, marts, validation
from starloom.session import stage_table


@pytest.fixture(scope="module")
def stg(spark):
    return staged(spark)


@pytest.fixture(scope="module")
def accounts(spark, stg):
    return stage_table(clean.account_clean(stg["account"], "Source"))


@pytest.fixture(scope="module")
def districts(spark, stg):
    return stage_table(clean.district_clean(stg["district"]))


@pytest.fixture(scope="module")
def loans(spark, stg, accounts):
    return stage_table(clean.loan_clean(stg["loan"], accounts))


@pytest.fixture(scope="module")
def transactions(spark, stg, accounts):
    return stage_table(clean.transaction_clean(stg["trans"], accounts))


@pytest.fixture(scope="module")
def warehouse_dims(spark, accounts, districts):
    new = dims.new_dimensions(spark)
    return {
        "DimDate": dims.dim_date(spark, dt.date(1995, 1, 1), dt.date(1998, 12, 31)),
        "DimDistrict": stage_table(dims.load_district(new["DimDistrict"], districts).drop(ACTION)),
        "DimAccount": stage_table(dims.load_account(new["DimAccount"], accounts).drop(ACTION)),
        "DimLoanStatus": dims.load_lookup(
            new["DimLoanStatus"], dims.loan_status_values(spark), "LoanStatusCode", "LoanStatusKey"
        ).drop(ACTION),
        "DimTransactionType": dims.load_lookup(
            new["DimTransactionType"], dims.transaction_type_values(spark), "TransactionTypeCode",
            "TransactionTypeKey",
        ).drop(ACTION),
        "DimOperation": dims.load_lookup(
            new["DimOperation"], dims.operation_values(spark), "OperationCode", "OperationKey"
        ).drop(ACTION),
    }


# --- clean tables ---


def test_account_clean(accounts, rows):
    assert rows(accounts, "AccountID", "DistrictID", "StatementFrequency", "AccountOpenDateKey",
                "AccountAgeYears", "AccountAgeGroup") == [
        (1, 10, "Monthly", 19950324, 4, "1-4 Years"), (2, -1, "Weekly", 19900101, 9, "5-9 Years"),
        (3, 99, "After Transaction", 19000101, None, "Unknown"), (4, 20, "Unknown", 19990101, 0, "Other"),
        (5, 20, "Unknown", 19890101, 10, "Other"), (6, 10, "Weekly", 19940630, 5, "5-9 Years"),
        (7, 30, "Unknown", 19981231, 1, "1-4 Years")]
    assert rows(accounts.select("SourceSystem", "ETL_LoadDateTime").distinct()) == [("Source", RUN)]


def test_district_clean(districts, rows):
    assert rows(districts.drop("ETL_LoadDateTime")) == [
        (10, "Praha", "Prague", 1204953, 12542, D("0.43"), 167, 99107),
        (20, "Unknown", "Unknown", 42821, 8173, D("1.67"), 124, 1358),
        (30, "Benesov", "Bohemia", 88884, None, None, None, None)]


def test_client_clean(spark, stg, districts, rows):
    cleaned = clean.client_clean(stg["client"], stg["disp"], districts)
    assert rows(cleaned, "ClientID", "DistrictID", "ClientRole", "DispositionID", "AccountID",
                "AgeAtDatasetEnd") == [
        (1, 10, "Owner", 6, 2, 29), (2, -1, "Unknown", 8, 2, 54), (3, -1, "Authorized User", 9, 3, None),
        (4, 20, "Unknown", None, None, 43)]


def test_loan_clean(loans, rows):
    assert rows(loans, "LoanID", "DistrictID", "LoanDateKey", "LoanStatusCode", "LoanStatusGroup",
                "ExpectedPaymentAmount", "ProblemLoanCount") == sorted([
        (1, 10, 19970105, "A", "Completed", D("1080.00"), 0), (2, -1, 19960201, "B", "Completed", D("612.00"), 1),
        (3, -1, 19980301, "C", "Active", D("108.00"), 0), (4, 20, 19000101, "D", "Active", D("108.00"), 1),
        (5, 20, 20010101, "D", "Active", D("108.00"), 1), (9, 10, 19970101, "UNKNOWN", "Unknown", D("12.00"), 0),
        (10, 30, 19970101, "UNKNOWN", "Unknown", D("12.00"), 0),
        (11, 99, 19970101, "UNKNOWN", "Unknown", D("12.00"), 0)], key=repr)


def test_transaction_clean(transactions, rows):
    assert rows(transactions, "TransactionID", "TransactionTypeCode", "OperationCode", "InflowAmount",
                "OutflowAmount", "SignedAmount", "BalanceAfterTransaction", "PurposeCode") == sorted([
        (1, "PRIJEM", "VKLAD", D("100.00"), D("0.00"), D("100.00"), D("100.00"), "SIPO"),
        (2, "VYDAJ", "VYBER KARTOU", D("0.00"), D("30.00"), D("-30.00"), None, "UNKNOWN"),
        (3, "VYBER", "UNKNOWN", D("0.00"), D("5.50"), D("-5.50"), D("1.00"), "UNKNOWN"),
        (4, "UNKNOWN", "AKREDITIV", D("0.00"), D("0.00"), D("0.00"), D("1.00"), "UNKNOWN"),
        (8, "PRIJEM", "UNKNOWN", D("8.00"), D("0.00"), D("8.00"), D("1.00"), "UNKNOWN"),
        (9, "UNKNOWN", "UNKNOWN", D("0.00"), D("0.00"), D("0.00"), None, "UNKNOWN")], key=repr)


# --- dimensions ---


def test_calendar(spark):
    days = dims.dim_date(spark)
    assert days.count() == 36_159
    row = days.filter("DateKey = 19981231").first()
    assert (row.DayName, row.WeekNumber, row.MonthName, row.Quarter, row.YearMonth, row.FullDate) == (
        "Thursday", 53, "December", 4, "12", dt.date(1998, 12, 31))


def test_dimension_keys_follow_the_unknown_member(warehouse_dims, rows):
    assert rows(warehouse_dims["DimDistrict"], "DistrictKey", "DistrictID") == [
        (0, -1), (1, 10), (2, 20), (3, 30)]
    opened = dict(rows(warehouse_dims["DimAccount"], "AccountID", "EffectiveFrom"))
    assert opened[1] == d(1995, 3, 24) and opened[3] is None and opened[-1] == K.BEGINNING
    assert rows(warehouse_dims["DimLoanStatus"], "LoanStatusKey", "LoanStatusCode", "ProblemFlag") == [
        (0, "UNKNOWN", False), (1, "A", False), (2, "B", True), (3, "C", False), (4, "D", True)]


def test_client_dimension(spark, stg, districts, warehouse_dims, rows):
    cleaned = clean.client_clean(stg["client"], stg["disp"], districts)
    empty = spark.createDataFrame([], S.DIM_CLIENT)
    first = dims.load_client(empty, cleaned, warehouse_dims["DimDistrict"])
    assert rows(first, "ClientKey", "ClientID", "DistrictKey", "EffectiveFrom", "IsCurrent", ACTION) == [
        (1, 1, 1, RUN.date(), True, "inserted"), (2, 2, 0, RUN.date(), True, "inserted"),
        (3, 3, 0, RUN.date(), True, "inserted"), (4, 4, 2, RUN.date(), True, "inserted")]


def test_lookups_from_codes(spark, stg, rows):
    empty = dims.empty_dim(spark, S.DIM_LOAN_STATUS, "LoanStatusKey")
    args = (stg["loan"], "status", "LoanStatusCode", "LoanStatusKey", dims.describe_loan_status)
    first = dims.dim_from_codes(empty, *args)
    assert rows(first, "LoanStatusKey", "LoanStatusCode", "LoanStatusDescription") == [
        (0, "UNKNOWN", "Unknown Loan Status"), (1, "A", "Completed Without Repayment Problems"),
        (2, "B", "Completed With Repayment Problems"),
        (3, "C", "Active Without Current Repayment Problems"), (4, "D", "Active With Current Debt"),
        (5, "Q", "Other Loan Status")]
    assert rows(dims.dim_from_codes(first, *args)) == rows(first)


def test_english_codes_are_understood(spark, rows):
    codes = spark.createDataFrame([("INCOMING",), ("DEBIT",), ("ZZ",)], "TransactionTypeCode string")
    assert rows(dims.describe_transaction_type(codes)) == [
        ("DEBIT", "Debit", "Outgoing"), ("INCOMING", "Other Transaction Type", "Incoming"),
        ("ZZ", "Other Transaction Type", "Unknown")]
    codes = spark.createDataFrame([("REMITTANCE TO ANOTHER BANK",), ("ZZ",)], "OperationCode string")
    assert rows(dims.describe_operation(codes)) == [
        ("REMITTANCE TO ANOTHER BANK", "Outgoing Bank Transfer", "Bank Transfer"),
        ("ZZ", "Other Operation", "Unknown")]


def test_district_dimension_from_text(spark, rows):
    columns = ["district_id", *[f.name for f in S.DISTRICT.fields[1:]]]
    data = [("1", " A ", "", "100", "8173.5", "?", "7.01", "124", "?", "1358"),
            ("x", "B", "b", "1", "1", "1", "1", "1", "1", "1"),
            ("2", None, " r", "?", "?", "1.85", "?", " ", "2674", " ")]
    text = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
    dim = dims.dim_district(dims.empty_dim(spark, S.DIM_DISTRICT, "DistrictKey"), text)
    assert rows(dim.filter("DistrictKey > 0")) == [
        (1, 1, "A", "Unknown", 100, 8174, D("7.01"), 124, 1358),
        (2, 2, "Unknown", "r", None, None, D("1.85"), None, 2674)]
    stats = validation.district_statistics(dim).first()
    assert (stats.DistinctSourceDistricts, stats.MinimumPopulation, stats.MissingPopulation,
            stats.MissingCrimeMeasure) == (2, 100, 1, 0)


# --- facts ---


def test_loans_dropped_or_kept(spark, loans, warehouse_dims, rows):
    dropped = facts.resolve_loans(loans, warehouse_dims, "drop")
    # no account 99, no district 99, dates outside the calendar
    assert [r[0] for r in rows(dropped.rows, "LoanID")] == [1, 10, 2, 9]
    kept = facts.resolve_loans(loans, warehouse_dims, "unknown")
    assert rows(kept.rows, "LoanID", "AccountKey", "DistrictKey") == sorted(
        [(1, 1, 1), (2, 2, 0), (3, 0, 0), (9, 6, 1), (10, 7, 3), (11, 3, 0)], key=repr)
    assert dict((r[0], r[2]) for r in rows(kept.unmatched)) == {
        "_date": 2, "AccountKey": 1, "DistrictKey": 1, "LoanStatusKey": 0}


def test_loan_upsert_is_idempotent(spark, loans, warehouse_dims, rows):
    load = facts.resolve_loans(loans, warehouse_dims)
    first = stage_table(facts.upsert_loans(spark.createDataFrame([], S.FACT_LOAN), load).drop(ACTION))
    again = facts.upsert_loans(first, load)
    assert rows(again.drop(ACTION)) == rows(first)
    assert rows(again.groupBy(ACTION).count()) == [("updated", 6)]


def test_rebuild_keeps_bad_numbers_as_zero(spark, warehouse_dims, rows):
    found = sources(spark)
    loan = found["loan"].withColumn(
        "amount", F.when(F.col("loan_id") == 9, "x").otherwise(F.col("amount").cast("string")))
    account = found["account"].dropna(subset=["account_id"]).distinct()
    built = facts.rebuild_loans(loan, account, warehouse_dims)
    got = {r.LoanID: r for r in built.collect()}
    assert sorted(got) == [1, 2, 3, 6, 7, 8, 9, 10, 11]
    assert got[9].LoanAmount == 0 and got[9].LoanStatusKey == 0 and got[8].MonthlyPayment == -1
    assert (got[3].AccountKey, got[3].DistrictKey) == (0, 0) and got[2].ProblemLoanCount == 1
    assert (got[2].AccountKey, got[2].DistrictKey) == (2, 0)
    assert sorted(r.LoanKey for r in got.values()) == list(range(1, 10))


def test_rebuild_gates(spark, warehouse_dims):
    found = sources(spark)
    account = found["account"].dropna(subset=["account_id"]).distinct()
    no_zero = {**warehouse_dims, "DimDistrict": warehouse_dims["DimDistrict"].filter("DistrictKey > 0")}
    with pytest.raises(LoadGateError, match="DistrictKey 0 is missing"):
        facts.rebuild_loans(found["loan"], account, no_zero)
    twice = spark.createDataFrame([LOAN[0], LOAN[0]], S.LOAN)
    with pytest.raises(LoadGateError, match="duplicate keys in loan_id"):
        facts.rebuild_loans(twice, account, warehouse_dims)


@pytest.mark.parametrize("increment", [False, True])
def test_append_only_adds_what_is_new(spark, transactions, warehouse_dims, rows, increment):
    empty = spark.createDataFrame([], S.FACT_TRANSACTION)
    early = transactions.filter("DateKey < 19970201")
    first = stage_table(facts.append_transactions(empty, early, warehouse_dims).rows)
    assert rows(first, "TransactionKey", "TransactionID") == [(1, 1), (2, 2)]
    more = facts.append_transactions(first, transactions, warehouse_dims, increment=increment)
    assert rows(more.rows, "TransactionKey", "TransactionID", "OperationKey") == [
        (3, 3, 0), (4, 4, 0), (5, 9, 0)]
    assert dict((r[0], r[2]) for r in rows(more.unmatched))["_date"] == 1
    done = stage_table(first.unionByName(more.rows))
    assert facts.append_transactions(done, transactions, warehouse_dims, increment=increment).rows.isEmpty()
    strict = facts.append_transactions(first, transactions, warehouse_dims, "drop")
    # an unlisted operation, an unlisted district
    assert rows(strict.rows, "TransactionID") == [(3,)]


# --- marts and reports ---


def test_marts_and_reconciliation(spark, loans, transactions, warehouse_dims, rows):
    loan_rows = facts.resolve_loans(loans, warehouse_dims)
    fact_loan = stage_table(
        facts.upsert_loans(spark.createDataFrame([], S.FACT_LOAN), loan_rows).drop(ACTION))
    fact = stage_table(facts.append_transactions(
        spark.createDataFrame([], S.FACT_TRANSACTION), transactions, warehouse_dims).rows)
    monthly = marts.monthly_transactions(fact, warehouse_dims["DimDate"])
    assert rows(monthly) == [
        (1997, 1, "January", 1, "1997-01", 2, 1, D("130.00"), D("100.00"), D("30.00"), D("70.00"), D("65.00")),
        (1997, 2, "February", 1, "1997-02", 3, 3, D("21.50"), D("0.00"), D("5.50"), D("-5.50"), D("7.17"))]
    district = marts.district_loans(fact_loan, warehouse_dims["DimDistrict"])
    assert rows(district, "DistrictID", "TotalLoans", "TotalLoanAmount", "ProblemLoanPercentage") == [
        (10, 2, D("1010.00"), D("0.00")), (30, 1, D("10.00"), D("0.00"))]
    # loans of the unknown district are in the fact but not in the mart
    assert marts.excluded_loans(fact_loan, warehouse_dims["DimDistrict"]).first()[0] == 3
    report = validation.reconciliation(fact_loan, fact, monthly, district)
    assert rows(report) == [
        ("Loan data mart", 6, 3, "FAIL"), ("Problem-loan data mart", 1, 0, "FAIL"),
        ("Transaction data mart", 5, 5, "PASS")]
    nothing = validation.reconciliation(
        fact_loan.limit(0), fact.limit(0), monthly.limit(0), district.limit(0))
    assert {r.ValidationStatus for r in nothing.collect()} == {"FAIL"}
    listing = marts.loan_listing(fact_loan, warehouse_dims, 3)
    assert [(r.LoanID, r.AccountID, r.LoanStatusCode) for r in listing.collect()] == [
        (2, 2, "B"), (9, 6, "UNKNOWN"), (10, 7, "UNKNOWN")]
    assert all(r.InvalidRows == 0 for r in validation.integrity_report(
        fact_loan, fact, warehouse_dims).collect())


def test_coverage_of_a_lookup(spark, stg, warehouse_dims, rows):
    report = validation.mapping_coverage(
        stg["loan"], "status", warehouse_dims["DimLoanStatus"], "LoanStatusCode", "LoanStatusKey",
        {"LoanStatusGroup": "Unknown"}, "LoanCount", "SourceLoanStatus", "amount", "Total")
    assert ("Q", 0, "Unknown", 1, D("10.00")) in rows(report)
    assert rows(validation.unmapped_values(
        stg["loan"], "status", warehouse_dims["DimLoanStatus"], "LoanStatusCode", "v")) == [("Q",)]
