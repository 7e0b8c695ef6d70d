"""Profiles and validation reports over the stages of a load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions import norm_code, ratio, total
from starloom.operators import (
    Reference,
    broken_references,
    check_rules,
    count_where,
    counts_match,
    duplicate_keys,
    missing_profile,
    orphan_count,
    totals_match,
)
from starloom.session import stage_table

Tables = Mapping[str, DataFrame]


# --- staging profile ----------------------------------------------------------


def duplicate_identifiers(tables: Tables, ids: Mapping[str, str]) -> DataFrame:
    """Repeated identifiers of several tables: table, id, count."""
    parts = [
        duplicate_keys(tables[name], column).select(
            F.lit(name).alias("TableName"),
            F.col(column).cast("bigint").alias("DuplicateID"),
            "DuplicateCount",
        )
        for name, column in ids.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _missing(df: DataFrame, names: Mapping[str, str], texts: tuple[str, ...], **rows: str) -> DataFrame:
    """Missing values per column; ``texts`` are missing when blank, too."""
    return missing_profile(
        df, {c: n for c, n in names.items() if c not in texts}, {c: names[c] for c in texts}, **rows)


def missing_in_account(account: DataFrame) -> DataFrame:
    return _missing(account, K.MISSING_IN_ACCOUNT, ("frequency",))


def missing_in_transactions(trans: DataFrame) -> DataFrame:
    return _missing(trans, K.MISSING_IN_TRANSACTIONS, ("type", "operation"), rows="TotalTransactions")


def missing_in_loans(loan: DataFrame) -> DataFrame:
    return _missing(loan, K.MISSING_IN_LOANS, ("status",))


def invalid_loans(loan: DataFrame) -> DataFrame:
    bad = (F.col("amount") <= 0) | (F.col("duration") <= 0) | (F.col("payments") <= 0)
    return count_where(loan, {"InvalidLoanRecords": bad})


def client_dispositions(client: DataFrame, disp: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` client rows with their dispositions.

    A client has at least one row, so the first ``n`` rows belong to the first
    ``n`` clients, and none of them can show more than ``n`` dispositions; only
    those few rows are joined, however many a client has.
    """
    first = stage_table(client.orderBy("client_id").limit(n), "first_clients")
    place = F.row_number().over(Window.partitionBy("client_id").orderBy("disp_id"))
    theirs = (
        disp.join(F.broadcast(first.select("client_id")), "client_id", "left_semi")
        .withColumn("_place", place)
        .filter(F.col("_place") <= n)
    )
    return (
        first.join(theirs, "client_id", "left")
        .select(
            "client_id", "birth_number", "district_id", "disp_id", "account_id",
            F.col("type").alias("ClientRole"),
        )
        .orderBy("client_id", F.asc_nulls_first("disp_id"))
        .limit(n)
    )


# --- after each load ----------------------------------------------------------


def missing_after_load(source: DataFrame, target: DataFrame, key: str, name: str) -> DataFrame:
    """One row: source rows whose key did not arrive."""
    return orphan_count(source, key, target, key, name)


def member_counts(dim: DataFrame, id_column: str) -> DataFrame:
    unknown = F.col(id_column) == K.UNKNOWN_ID
    return dim.agg(
        F.count("*").alias("TotalRows"),
        F.count_if(unknown).alias("UnknownRows"),
        F.count_if(~unknown).alias("BusinessRows"),
    )


def current_counts(dim: DataFrame) -> DataFrame:
    """One row: current and historical rows of a dimension with history."""
    current = F.coalesce("IsCurrent", F.lit(False))
    return dim.agg(
        F.count("*").alias("TotalRows"),
        F.count_if(current).alias("CurrentRows"),
        F.count_if(~current).alias("HistoricalRows"),
    )


def repeated_current(dim: DataFrame, id_column: str) -> DataFrame:
    """Ids with more than one current row."""
    return duplicate_keys(dim.filter("IsCurrent"), id_column).select(id_column, "DuplicateCount")


def invalid_district_clients(clients: DataFrame, districts: DataFrame) -> DataFrame:
    """One row: clean clients whose district the dimension does not have."""
    return orphan_count(clients, "DistrictID", districts, "DistrictID", "ClientsWithInvalidDistrict")


def missing_balances(clean: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: missing balances before and after the load."""
    def missing(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count_if(F.col("BalanceAfterTransaction").isNull()).alias(name))

    # two single rows side by side
    one = F.lit(1).alias("_one")
    left = missing(clean, "MissingInSource").select(one, "MissingInSource")
    right = missing(fact, "MissingInFact").select(one, "MissingInFact")
    return left.join(right, "_one").select("MissingInSource", "MissingInFact")


def invalid_transactions(trans: DataFrame) -> DataFrame:
    """One row: transactions with a negative amount."""
    return count_where(trans, {"NegativeAmounts": F.col("amount") < 0})


def loan_references(dims: Tables, prefix: str = "FactLoan invalid ") -> list[Reference]:
    return [
        Reference(f"{prefix}AccountKey", "AccountKey", dims["DimAccount"], "AccountKey"),
        Reference(f"{prefix}DistrictKey", "DistrictKey", dims["DimDistrict"], "DistrictKey"),
        Reference(
            f"{prefix}LoanStatusKey", "LoanStatusKey", dims["DimLoanStatus"], "LoanStatusKey"
        ),
    ]


def transaction_references(dims: Tables, prefix: str = "FactTransaction invalid ") -> list[Reference]:
    return [
        Reference(f"{prefix}AccountKey", "AccountKey", dims["DimAccount"], "AccountKey"),
        Reference(f"{prefix}DistrictKey", "DistrictKey", dims["DimDistrict"], "DistrictKey"),
        Reference(
            f"{prefix}TransactionTypeKey", "TransactionTypeKey", dims["DimTransactionType"],
            "TransactionTypeKey",
        ),
        Reference(f"{prefix}OperationKey", "OperationKey", dims["DimOperation"], "OperationKey"),
    ]


def date_reference(dims: Tables, column: str, label: str) -> Reference:
    return Reference(label, column, dims["DimDate"], "DateKey")


def integrity_report(loans: DataFrame, transactions: DataFrame, dims: Tables) -> DataFrame:
    """Fact rows with a key no dimension has; each fact is scanned once."""
    return broken_references(loans, loan_references(dims)).unionByName(
        broken_references(transactions, transaction_references(dims))
    )


STAGE_CHECKS = K.STAGE_CHECKS


def stage_row_counts(tables: Tables) -> DataFrame:
    """Row counts before and after every stage, PASS when equal."""
    needed = {name: tables[name] for check in STAGE_CHECKS for name in check[1:]}
    return counts_match(needed, STAGE_CHECKS)


def reconciliation(
    loans: DataFrame, transactions: DataFrame, monthly: DataFrame, districts: DataFrame
) -> DataFrame:
    """Warehouse totals against mart totals, PASS when equal."""
    return totals_match(
        [
            (K.TRANSACTION_MART, transactions, F.sum("TransactionCount"),
             monthly, F.sum("TotalTransactions")),
            (K.LOAN_MART, loans, F.sum("LoanCount"), districts, F.sum("TotalLoans")),
            (K.PROBLEM_LOAN_MART, loans, F.sum("ProblemLoanCount"),
             districts, F.sum("ProblemLoans")),
        ]
    )


def mart_sheet(monthly: DataFrame, districts: DataFrame) -> DataFrame:
    def row(name: str, df: DataFrame, column: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("SummaryRows"), F.sum(column).alias("ReconciledRecordCount")
        ).select(F.lit(name).alias("DataMartTable"), "SummaryRows", "ReconciledRecordCount")

    return row(K.MONTHLY_MART, monthly, "TotalTransactions").unionByName(
        row(K.DISTRICT_MART, districts, "TotalLoans")
    )


# --- lookup coverage ------------------------------------------------------------


def mapping_coverage(
    source: DataFrame,
    column: str,
    dim: DataFrame,
    code: str,
    key: str,
    defaults: Mapping[str, object],
    count: str,
    source_name: str,
    amount: str | None = None,
    amount_name: str = "TotalAmount",
) -> DataFrame:
    """Source codes, the member each maps to (``defaults`` if none), and their rows.

    The source is summed per code first; only the codes are joined.
    """
    aggregates = [F.count("*").alias(count)]
    if amount:
        aggregates.append(total(F.col(amount).try_cast("decimal(18,2)")).alias(amount_name))
    per_code = source.groupBy(norm_code(column).alias(code)).agg(*aggregates)
    mapped = per_code.join(dim.select(code, key, *defaults), code, "left")
    return mapped.select(
        F.col(code).alias(source_name),
        F.coalesce(key, F.lit(K.UNKNOWN_KEY)).alias(key),
        *[F.coalesce(c, F.lit(v)).alias(c) for c, v in defaults.items()],
        *[c for c in per_code.columns if c != code],
    ).orderBy(source_name)


def unmapped_values(
    source: DataFrame, column: str, dim: DataFrame, code: str, name: str
) -> DataFrame:
    """Distinct raw values whose normalised code the dimension lacks."""
    values = source.select(F.col(column).alias(name)).distinct()
    return values.withColumn(code, norm_code(name)).join(
        dim.select(code), code, "left_anti"
    ).select(name)


def district_statistics(dim: DataFrame) -> DataFrame:
    """One row describing the district dimension, unknown member set apart."""
    business = F.col("DistrictID") != K.UNKNOWN_ID

    def when(column: str):
        return F.when(business, F.col(column))

    def missing(column: str):
        return F.count_if(business & F.col(column).isNull())

    return dim.agg(
        F.count("*").alias("TotalDimDistrictRows"),
        F.count_distinct(when("DistrictID")).alias("DistinctSourceDistricts"),
        F.min(when("Population")).alias("MinimumPopulation"),
        F.max(when("Population")).alias("MaximumPopulation"),
        ratio(F.sum("AverageSalary"), F.count("AverageSalary")).alias("OverallAverageSalary"),
        missing("Population").alias("MissingPopulation"),
        missing("AverageSalary").alias("MissingAverageSalary"),
        missing("UnemploymentMeasure").alias("MissingUnemployment"),
        missing("EntrepreneurMeasure").alias("MissingEntrepreneurMeasure"),
        missing("CrimeMeasure").alias("MissingCrimeMeasure"),
    )


# --- table rules ------------------------------------------------------------------


def _values(rows, place: int) -> list:
    """What stands at a place of the rows of a value table."""
    return sorted({row[place] for row in rows})


def fact_loan_rules(fact: DataFrame, dims: Tables) -> DataFrame:
    measures = [
        "LoanCount", "LoanAmount", "LoanDurationMonths", "MonthlyPayment",
        "ExpectedPaymentAmount",
    ]
    return check_rules(
        fact,
        not_null=[
            "LoanKey", "LoanID", "LoanDateKey", "AccountKey", "DistrictKey", "LoanStatusKey",
            *measures, "ProblemLoanCount",
        ],
        unique=["LoanKey", "LoanID"],
        allowed={"ProblemLoanCount": [0, 1]},
        at_least={m: 0 for m in measures},
        references=[
            *loan_references(dims, "unmatched "),
            date_reference(dims, "LoanDateKey", "unmatched LoanDateKey"),
        ],
        table="FactLoan",
    )


def fact_transaction_rules(fact: DataFrame, dims: Tables) -> DataFrame:
    measures = ["TransactionCount", "TransactionAmount", "InflowAmount", "OutflowAmount"]
    return check_rules(
        fact,
        not_null=[
            "TransactionKey", "TransactionID", "DateKey", "AccountKey", "DistrictKey",
            "TransactionTypeKey", "OperationKey", *measures, "SignedAmount",
        ],
        unique=["TransactionKey", "TransactionID"],
        at_least={m: 0 for m in measures},
        references=[
            *transaction_references(dims, "unmatched "),
            date_reference(dims, "DateKey", "unmatched DateKey"),
        ],
        table="FactTransaction",
    )


def dim_date_rules(dim: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["DateKey", "FullDate", "DayNumber", "MonthNumber", "Quarter", "Year"],
        unique=["DateKey", "FullDate"],
        allowed={"Quarter": [1, 2, 3, 4]},
        at_least={"DayNumber": 1, "MonthNumber": 1, "WeekNumber": 1},
        table="DimDate",
    )


def dim_account_rules(dim: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["AccountKey", "AccountID", "AccountOpenDate", "StatementFrequency", "IsCurrent"],
        unique=["AccountKey"],
        allowed={
            "StatementFrequency": [*K.STATEMENT_FREQUENCY.values(), K.UNKNOWN_TEXT],
            "AccountAgeGroup": ["1-4 Years", "5-9 Years", "Other", K.UNKNOWN_TEXT],
        },
        table="DimAccount",
    )


def dim_client_rules(dim: DataFrame, districts: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["ClientKey", "ClientID", "DistrictKey", "ClientRole", "IsCurrent"],
        unique=["ClientKey"],
        allowed={"ClientRole": [*K.CLIENT_ROLE.values(), K.UNKNOWN_TEXT]},
        references=[Reference("unmatched DistrictKey", "DistrictKey", districts, "DistrictKey")],
        table="DimClient",
    )


def dim_district_rules(dim: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["DistrictKey", "DistrictID", "DistrictName", "RegionName"],
        unique=["DistrictKey", "DistrictID"],
        at_least={
            m: 0
            for m in (
                "Population", "AverageSalary", "UnemploymentMeasure", "EntrepreneurMeasure",
                "CrimeMeasure",
            )
        },
        table="DimDistrict",
    )


def dim_loan_status_rules(dim: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["LoanStatusKey", "LoanStatusCode"],
        unique=["LoanStatusKey", "LoanStatusCode"],
        allowed={"LoanStatusGroup": _values(K.LOAN_STATUS, 2)},
        table="DimLoanStatus",
    )


def dim_transaction_type_rules(dim: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["TransactionTypeKey", "TransactionTypeCode"],
        unique=["TransactionTypeKey", "TransactionTypeCode"],
        allowed={"CashFlowDirection": _values(K.TRANSACTION_TYPE, 2)},
        table="DimTransactionType",
    )


def dim_operation_rules(dim: DataFrame) -> DataFrame:
    return check_rules(
        dim,
        not_null=["OperationKey", "OperationCode"],
        unique=["OperationKey", "OperationCode"],
        allowed={"OperationGroup": _values(K.OPERATION, 2)},
        table="DimOperation",
    )


def mart_rules(monthly: DataFrame, districts: DataFrame) -> DataFrame:
    """The marts' keys: one row per month, one per district."""
    month = F.col("Year") * 100 + F.col("MonthNumber")
    return check_rules(
        monthly.withColumn("Month", month),
        not_null=["Year", "MonthNumber"],
        unique=["Month"],
        table=K.MONTHLY_MART,
    ).unionByName(
        check_rules(
            districts, not_null=["DistrictKey"], unique=["DistrictKey"],
            table=K.DISTRICT_MART,
        )
    )
