"""Marts, reconciliation, integrity, rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalogue.bank import Bank
from catalogue.checks import big, mean2, norm, signed_case, sum2
from catalogue.registry import query
from catalogue.roles import OBSERVED_TO, RUN_TS, SOURCE_SYSTEM, role, table
from starloom.functions import date_key, inflow, money, norm_code, outflow, signed
from starloom.operators import Reference, broken_references, check_rules
from starloom.plans import dims, facts, marts, validation
from starloom.plans.warehouse import Warehouse
from starloom.session import new_path, stage_table


@query(f"""SELECT CAST(year(date) AS INTEGER) AS Year, CAST(month(date) AS INTEGER) AS MonthNumber,
                  monthname(date) AS MonthName, CAST(quarter(date) AS INTEGER) AS Quarter,
                  strftime(date, '%Y-%m') AS YearMonthLabel, count(*) AS TotalTransactions,
                  count(DISTINCT account_id) AS ActiveAccounts, {sum2('amount')} AS TotalTransactionAmount,
                  {sum2(signed_case(norm('type'), 'amount', '0'))} AS TotalInflow,
                  {sum2(signed_case(norm('type'), '0', 'amount'))} AS TotalOutflow,
                  {sum2(signed_case(norm('type'), 'amount', '-amount'))} AS NetCashFlow,
                  {mean2('sum(amount)', 'count(*)')} AS AverageTransactionAmount
           FROM trans WHERE date IS NOT NULL AND amount IS NOT NULL GROUP BY ALL""")
def monthly_mart(spark, sf_dir):
    """The flagship: every transaction of the source, summed per month."""
    fact = (
        role(spark, sf_dir, "trans")
        .filter("date IS NOT NULL AND amount IS NOT NULL")
        .select(
            date_key("date", missing=None).alias("DateKey"),
            F.col("account_id").alias("AccountKey"),
            F.lit(1).alias("TransactionCount"),
            money("amount").alias("TransactionAmount"),
            inflow("type", "amount").alias("InflowAmount"),
            outflow("type", "amount").alias("OutflowAmount"),
            signed("type", "amount").alias("SignedAmount"),
        )
    )
    calendar = dims.dim_date(spark, end=dt.date(2049, 12, 31))
    return marts.monthly_transactions(fact, calendar)


@query("SELECT * FROM monthly")
def monthly_mart_of_load(spark, sf_dir):
    """The same mart at the end of a whole load."""
    return Bank(spark, sf_dir).monthly


@query("SELECT * FROM monthly")
def monthly_mart_refresh(spark, sf_dir):
    """The mart of all transactions but the odd accounts' ones since 1996, refreshed when these arrive."""
    bank = Bank(spark, sf_dir)
    late = (F.col("DateKey") > 19960000) & (F.col("AccountKey") % 2 == 1)
    fact = facts.transaction_table(spark, new_path(spark, "fact_months"))
    rows = facts.with_year(bank.fact_transaction)
    early = fact.publish(rows.filter(~late))
    mart = stage_table(marts.monthly_transactions(early, bank.dim_date), "monthly_before")
    arrived = stage_table(rows.filter(late), "late")
    fact.append(arrived)
    months = [r[0] for r in arrived.select(F.floor(F.col("DateKey") / 100).cast("int")).distinct().collect()]
    return marts.refresh_monthly(mart, fact.read(), bank.dim_date, months)


@query("SELECT * FROM monthly ORDER BY Year, MonthNumber LIMIT 12")
def first_months(spark, sf_dir):
    return marts.first_months(Bank(spark, sf_dir).monthly)


@query("SELECT * FROM district_mart")
def district_loan_mart(spark, sf_dir):
    return Bank(spark, sf_dir).district_mart


@query("""SELECT * FROM district_mart
          ORDER BY ProblemLoanPercentage DESC, TotalLoanAmount DESC, DistrictKey LIMIT 10""")
def top_districts(spark, sf_dir):
    return marts.riskiest_districts(Bank(spark, sf_dir).district_mart)


@query("""SELECT CAST(coalesce(sum(LoanCount), 0) AS BIGINT) AS ExcludedLoans FROM fact_loan
          WHERE DistrictKey NOT IN (SELECT DistrictKey FROM dim_district WHERE DistrictID <> -1)""")
def excluded_loans(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return marts.excluded_loans(bank.fact_loan, bank.dim_district)


@query(f"""SELECT 'MonthlyTransactionPerformance' AS DataMartTable, count(*) AS SummaryRows,
                  {big('sum(TotalTransactions)')} AS ReconciledRecordCount FROM monthly
           UNION ALL SELECT 'DistrictLoanPerformance', count(*), {big('sum(TotalLoans)')} FROM district_mart""")
def mart_sheet(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.mart_sheet(bank.monthly, bank.district_mart)


STAGES = [(label, a, b) for label, a, b in validation.STAGE_CHECKS]
_NAMES = {"FactLoan": "fact_loan", "FactTransaction": "fact_transaction"}


_STAGE_COUNTS = (
    "SELECT ValidationCheck, SourceRows, TargetRows, CASE WHEN SourceRows = TargetRows THEN 'PASS' "
    "ELSE 'FAIL' END AS ValidationStatus FROM ("
    + " UNION ALL ".join(
        f"SELECT '{label}' AS ValidationCheck, (SELECT count(*) FROM {_NAMES.get(a, a)}) AS SourceRows, "
        f"(SELECT count(*) FROM {_NAMES.get(b, b)}) AS TargetRows"
        for label, a, b in STAGES)
    + ")"
)


@query(_STAGE_COUNTS)
def whole_load(spark, sf_dir):
    """All stages by the runner, published as tables; its row-count report."""
    names = ["account", "client", "disp", "district", "loan", "trans", "card"]
    sources = {name: role(spark, sf_dir, name) for name in names}
    sources["order"] = table(spark, sf_dir, "orders")
    warehouse = Warehouse(
        spark, new_path(spark, "warehouse"), SOURCE_SYSTEM, observed_to=OBSERVED_TO
    )
    return warehouse.run(sources, RUN_TS)["row_counts"]


@query(_STAGE_COUNTS)
def stage_row_counts(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.stage_row_counts(
        {
            **{name: bank.stg(name) for name in ("account", "client", "district", "loan", "trans")},
            "account_clean": bank.account_clean,
            "client_clean": bank.client_clean,
            "district_clean": bank.district_clean,
            "loan_clean": bank.loan_clean,
            "transaction_clean": bank.transaction_clean,
            "FactLoan": bank.fact_loan,
            "FactTransaction": bank.fact_transaction,
        }
    )


def _integrity(fact: str, rows: str, key: str, dim: str) -> str:
    return (
        f"SELECT '{fact} invalid {key}' AS ValidationCheck, count(*) AS InvalidRows FROM {rows} f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"
    )


@query(" UNION ALL ".join([
    _integrity("FactLoan", "fact_loan", "AccountKey", "dim_account"),
    _integrity("FactLoan", "fact_loan", "DistrictKey", "dim_district"),
    _integrity("FactLoan", "fact_loan", "LoanStatusKey", "status_values"),
    _integrity("FactTransaction", "fact_transaction", "AccountKey", "dim_account"),
    _integrity("FactTransaction", "fact_transaction", "DistrictKey", "dim_district"),
    _integrity("FactTransaction", "fact_transaction", "TransactionTypeKey", "type_values"),
    _integrity("FactTransaction", "fact_transaction", "OperationKey", "operation_values"),
]))
def integrity_report(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.integrity_report(bank.fact_loan, bank.fact_transaction, bank.dims)


@query("""SELECT 'unlisted district' AS ValidationCheck, count(*) AS InvalidRows FROM account
              WHERE district_id IS NULL OR district_id NOT IN (SELECT district_id FROM district)
          UNION ALL SELECT 'no opening date in calendar', count(*) FROM account
              WHERE date IS NULL OR date NOT IN (SELECT FullDate FROM dim_date)
          UNION ALL SELECT 'no client', count(*) FROM account
              WHERE account_id NOT IN (SELECT client_id FROM client)""")
def broken_keys(spark, sf_dir):
    """Accounts that refer to nothing: several references, one pass."""
    account = role(spark, sf_dir, "account")
    return broken_references(
        account,
        [
            Reference("unlisted district", "district_id", role(spark, sf_dir, "district"), "district_id"),
            Reference("no opening date in calendar", "date", Bank(spark, sf_dir).dim_date, "FullDate"),
            Reference("no client", "account_id", role(spark, sf_dir, "client"), "client_id"),
        ],
    )


@query("""SELECT ValidationCheck, WarehouseValue, DataMartValue,
                 CASE WHEN WarehouseValue = DataMartValue THEN 'PASS' ELSE 'FAIL' END AS ValidationStatus
          FROM (SELECT 'Transaction data mart' AS ValidationCheck,
                       CAST((SELECT sum(TransactionCount) FROM fact_transaction) AS BIGINT) AS WarehouseValue,
                       CAST((SELECT sum(TotalTransactions) FROM monthly) AS BIGINT) AS DataMartValue
                UNION ALL
                SELECT 'Loan data mart', CAST((SELECT sum(LoanCount) FROM fact_loan) AS BIGINT),
                       CAST((SELECT sum(TotalLoans) FROM district_mart) AS BIGINT)
                UNION ALL
                SELECT 'Problem-loan data mart', CAST((SELECT sum(ProblemLoanCount) FROM fact_loan) AS BIGINT),
                       CAST((SELECT sum(ProblemLoans) FROM district_mart) AS BIGINT))""")
def reconciliation(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.reconciliation(
        bank.fact_loan, bank.fact_transaction, bank.monthly, bank.district_mart
    )


def _rule(name: str, violations: str, table: str = "loan") -> str:
    return f"SELECT 'loan: {name}' AS Rule, {violations} AS Violations FROM {table}"


_LOAN_RULES = " UNION ALL ".join([
    _rule("loan_id not null", "count(*) - count(loan_id)"),
    _rule("date not null", "count(*) - count(date)"),
    _rule("code in list", "count(*) FILTER (code NOT IN ('A', 'B', 'C', 'D'))",
          "(SELECT coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') AS code FROM loan)"),
    _rule("amount >= 0", "count(*) FILTER (amount < 0)"),
    _rule("duration >= 24", "count(*) FILTER (duration < 24)"),
    _rule("loan_id unique", "count(loan_id) - count(DISTINCT loan_id)"),
    _rule("account_id unique", "count(account_id) - count(DISTINCT account_id)"),
    _rule("account exists", "count(*) FILTER (account_id IS NULL OR account_id NOT IN (SELECT account_id FROM account))"),
])


@query(f"SELECT *, CASE WHEN Violations = 0 THEN 'PASS' ELSE 'FAIL' END AS Status FROM ({_LOAN_RULES})")
def rule_report(spark, sf_dir):
    """Rules on the source loans, most of them broken."""
    loan = role(spark, sf_dir, "loan").withColumn("code", norm_code("status"))
    return check_rules(
        loan,
        not_null=["loan_id", "date"],
        unique=["loan_id", "account_id"],
        allowed={"code": ["A", "B", "C", "D"]},
        at_least={"amount": 0, "duration": 24},
        references=[
            Reference("account exists", "account_id", role(spark, sf_dir, "account"), "account_id")
        ],
        table="loan",
    )


_FACT_NOT_NULL = [
    "LoanKey", "LoanID", "LoanDateKey", "AccountKey", "DistrictKey", "LoanStatusKey", "LoanCount",
    "LoanAmount", "LoanDurationMonths", "MonthlyPayment", "ExpectedPaymentAmount", "ProblemLoanCount",
]
_FACT_RULES = " UNION ALL ".join(
    [f"SELECT 'FactLoan: {c} not null' AS Rule, count(*) - count({c}) AS Violations FROM fact_loan"
     for c in _FACT_NOT_NULL]
    + ["SELECT 'FactLoan: ProblemLoanCount in list', count(*) FILTER (ProblemLoanCount NOT IN (0, 1)) FROM fact_loan"]
    + [f"SELECT 'FactLoan: {c} >= 0', count(*) FILTER ({c} < 0) FROM fact_loan" for c in _FACT_NOT_NULL[6:11]]
    + [f"SELECT 'FactLoan: {c} unique', count({c}) - count(DISTINCT {c}) FROM fact_loan" for c in ("LoanKey", "LoanID")]
    + [f"SELECT 'FactLoan: unmatched {k}', count(*) FROM fact_loan WHERE {k} NOT IN (SELECT {p} FROM {d})"
       for k, p, d in (("AccountKey", "AccountKey", "dim_account"), ("DistrictKey", "DistrictKey", "dim_district"),
                       ("LoanStatusKey", "LoanStatusKey", "status_values"), ("LoanDateKey", "DateKey", "dim_date"))]
)


@query(f"SELECT *, CASE WHEN Violations = 0 THEN 'PASS' ELSE 'FAIL' END AS Status FROM ({_FACT_RULES})")
def fact_rules(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.fact_loan_rules(bank.fact_loan, bank.loan_dims)


def _dim_rules(table: str, name: str, not_null: list[str], allowed: str, at_least: list[str], unique: list[str]) -> list[str]:
    rules = [f"SELECT '{name}: {c} not null' AS Rule, count(*) - count({c}) AS Violations FROM {table}" for c in not_null]
    if allowed:
        column, values = allowed.split("|")
        rules.append(f"SELECT '{name}: {column} in list', count(*) FILTER ({column} NOT IN ({values})) FROM {table}")
    rules += [f"SELECT '{name}: {c} >= 0', count(*) FILTER ({c} < 0) FROM {table}" for c in at_least]
    rules += [f"SELECT '{name}: {c} unique', count({c}) - count(DISTINCT {c}) FROM {table}" for c in unique]
    return rules


_DIM_RULES = " UNION ALL ".join(
    _dim_rules("dim_district", "DimDistrict", ["DistrictKey", "DistrictID", "DistrictName", "RegionName"], "",
               ["Population", "AverageSalary", "UnemploymentMeasure", "EntrepreneurMeasure", "CrimeMeasure"],
               ["DistrictKey", "DistrictID"])
    + _dim_rules("status_values", "DimLoanStatus", ["LoanStatusKey", "LoanStatusCode"],
                 "LoanStatusGroup|'Completed', 'Active', 'Unknown'", [], ["LoanStatusKey", "LoanStatusCode"])
    + _dim_rules("type_values", "DimTransactionType", ["TransactionTypeKey", "TransactionTypeCode"],
                 "CashFlowDirection|'Incoming', 'Outgoing', 'Unknown'", [],
                 ["TransactionTypeKey", "TransactionTypeCode"])
    + _dim_rules("operation_values", "DimOperation", ["OperationKey", "OperationCode"],
                 "OperationGroup|'Cash Transaction', 'Card Transaction', 'Bank Transfer', 'Unknown'", [],
                 ["OperationKey", "OperationCode"])
    + ["SELECT 'MonthlyTransactionPerformance: Year not null', count(*) - count(Year) FROM monthly",
       "SELECT 'MonthlyTransactionPerformance: MonthNumber not null', count(*) - count(MonthNumber) FROM monthly",
       "SELECT 'MonthlyTransactionPerformance: Month unique', count(*) - count(DISTINCT (Year, MonthNumber)) FROM monthly",
       "SELECT 'DistrictLoanPerformance: DistrictKey not null', count(*) - count(DistrictKey) FROM district_mart",
       "SELECT 'DistrictLoanPerformance: DistrictKey unique', count(*) - count(DISTINCT DistrictKey) FROM district_mart"]
)


@query(f"SELECT *, CASE WHEN Violations = 0 THEN 'PASS' ELSE 'FAIL' END AS Status FROM ({_DIM_RULES})")
def dimension_and_mart_rules(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return (
        validation.dim_district_rules(bank.dim_district)
        .unionByName(validation.dim_loan_status_rules(bank.dim_loan_status))
        .unionByName(validation.dim_transaction_type_rules(bank.dim_transaction_type))
        .unionByName(validation.dim_operation_rules(bank.dim_operation))
        .unionByName(validation.mart_rules(bank.monthly, bank.district_mart))
    )


@query("""SELECT count(*) AS MissingDistrictsAfterLoad FROM district_clean
          WHERE DistrictID NOT IN (SELECT DistrictID FROM dim_district)""")
def missing_districts_after_load(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.missing_after_load(
        bank.district_clean, bank.dim_district, "DistrictID", "MissingDistrictsAfterLoad"
    )


@query("""SELECT count(*) AS MissingTransactionsAfterLoad FROM transaction_clean
          WHERE TransactionID NOT IN (SELECT TransactionID FROM fact_transaction)""")
def missing_transactions_after_load(spark, sf_dir):
    """None: the calendar holds every transaction's day."""
    bank = Bank(spark, sf_dir)
    return validation.missing_after_load(
        bank.transaction_clean, bank.fact_transaction, "TransactionID", "MissingTransactionsAfterLoad"
    )


@query("""SELECT count(*) AS TotalRows, count(*) FILTER (AccountID = -1) AS UnknownRows,
                 count(*) FILTER (AccountID <> -1) AS BusinessRows FROM dim_account""")
def member_counts(spark, sf_dir):
    return validation.member_counts(Bank(spark, sf_dir).dim_account, "AccountID")


_TRANSACTION_NOT_NULL = [
    "TransactionKey", "TransactionID", "DateKey", "AccountKey", "DistrictKey", "TransactionTypeKey",
    "OperationKey", "TransactionCount", "TransactionAmount", "InflowAmount", "OutflowAmount", "SignedAmount",
]
_TRANSACTION_RULES = " UNION ALL ".join(
    _dim_rules("fact_transaction", "FactTransaction", _TRANSACTION_NOT_NULL, "", _TRANSACTION_NOT_NULL[7:11],
               ["TransactionKey", "TransactionID"])
    + [f"SELECT 'FactTransaction: unmatched {k}', count(*) FROM fact_transaction WHERE {k} NOT IN (SELECT {k} FROM {d})"
       for k, d in (("AccountKey", "dim_account"), ("DistrictKey", "dim_district"), ("DateKey", "dim_date"),
                    ("TransactionTypeKey", "type_values"), ("OperationKey", "operation_values"))]
)


@query(f"SELECT *, CASE WHEN Violations = 0 THEN 'PASS' ELSE 'FAIL' END AS Status FROM ({_TRANSACTION_RULES})")
def fact_transaction_rules(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.fact_transaction_rules(bank.fact_transaction, bank.dims)


_HISTORY_RULES = " UNION ALL ".join(
    _dim_rules("dim_date", "DimDate", ["DateKey", "FullDate", "DayNumber", "MonthNumber", "Quarter", "Year"],
               "Quarter|1, 2, 3, 4", [], ["DateKey", "FullDate"])
    + [f"SELECT 'DimDate: {c} >= 1', count(*) FILTER ({c} < 1) FROM dim_date"
       for c in ("DayNumber", "MonthNumber", "WeekNumber")]
    + _dim_rules("dim_account", "DimAccount",
                 ["AccountKey", "AccountID", "AccountOpenDate", "StatementFrequency", "IsCurrent"],
                 "StatementFrequency|'Monthly', 'Weekly', 'After Transaction', 'Unknown'", [], ["AccountKey"])
    + ["SELECT 'DimAccount: AccountAgeGroup in list', "
       "count(*) FILTER (AccountAgeGroup NOT IN ('1-4 Years', '5-9 Years', 'Other', 'Unknown')) FROM dim_account"]
    + _dim_rules("dim_client", "DimClient", ["ClientKey", "ClientID", "DistrictKey", "ClientRole", "IsCurrent"],
                 "ClientRole|'Owner', 'Authorized User', 'Unknown'", [], ["ClientKey"])
    + ["SELECT 'DimClient: unmatched DistrictKey', count(*) FROM dim_client "
       "WHERE DistrictKey NOT IN (SELECT DistrictKey FROM dim_district)"]
)


@query(f"SELECT *, CASE WHEN Violations = 0 THEN 'PASS' ELSE 'FAIL' END AS Status FROM ({_HISTORY_RULES})")
def calendar_account_client_rules(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return (
        validation.dim_date_rules(bank.dim_date)
        .unionByName(validation.dim_account_rules(bank.dim_account))
        .unionByName(validation.dim_client_rules(bank.dim_client, bank.dim_district))
    )


@query("""SELECT count(*) AS ClientsWithInvalidDistrict FROM client_clean
          WHERE DistrictID NOT IN (SELECT DistrictID FROM dim_district)""")
def invalid_district_clients(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return validation.invalid_district_clients(bank.client_clean, bank.dim_district)


def _missing(name: str, clean: str, loaded: str, key: str, column: str):
    """Register the count of clean rows that a load left out."""

    @query(f"SELECT count(*) AS {column} FROM {clean} WHERE {key} NOT IN (SELECT {key} FROM {loaded})", name=name)
    def missing(spark, sf_dir):
        bank = Bank(spark, sf_dir)
        return validation.missing_after_load(getattr(bank, clean), getattr(bank, loaded), key, column)


_missing("missing_accounts_after_load", "account_clean", "dim_account", "AccountID", "MissingAccountsAfterLoad")
_missing("missing_clients_after_load", "client_clean", "dim_client", "ClientID", "MissingClientsAfterLoad")
_missing("missing_loans_after_load", "loan_clean", "fact_loan", "LoanID", "MissingLoansAfterLoad")


@query("""SELECT 'DimAccount' AS Dimension, count(*) AS TotalRows, count(*) FILTER (IsCurrent) AS CurrentRows,
                 count(*) FILTER (NOT IsCurrent) AS HistoricalRows FROM dim_account
          UNION ALL SELECT 'DimClient', count(*), count(*) FILTER (IsCurrent), count(*) FILTER (NOT IsCurrent)
          FROM dim_client""")
def current_counts(spark, sf_dir):
    bank = Bank(spark, sf_dir)

    def row(name, dim):
        return validation.current_counts(dim).withColumn("Dimension", F.lit(name))

    return row("DimAccount", bank.dim_account).unionByName(row("DimClient", bank.dim_client))


@query("""SELECT 'DimAccount' AS Dimension, count(*) AS RepeatedCurrent FROM (
              SELECT AccountID FROM dim_account WHERE IsCurrent GROUP BY AccountID HAVING count(*) > 1)
          UNION ALL SELECT 'DimClient', count(*) FROM (
              SELECT ClientID FROM dim_client WHERE IsCurrent GROUP BY ClientID HAVING count(*) > 1)""")
def repeated_current(spark, sf_dir):
    """How many ids have more than one current row."""
    bank = Bank(spark, sf_dir)

    def row(name, dim, key):
        found = validation.repeated_current(dim, key)
        return found.agg(F.lit(name).alias("Dimension"), F.count("*").alias("RepeatedCurrent"))

    return row("DimAccount", bank.dim_account, "AccountID").unionByName(
        row("DimClient", bank.dim_client, "ClientID")
    )
