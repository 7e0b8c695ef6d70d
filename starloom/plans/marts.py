"""Data marts and the loan reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions import ratio, total, year_month_label
from starloom.operators.joins import lookup_join
from starloom.session import part_of, stage_table

DISTRICT_COLUMNS = [
    "DistrictKey", "DistrictID", "DistrictName", "RegionName", "Population", "AverageSalary",
    "UnemploymentMeasure", "EntrepreneurMeasure", "CrimeMeasure",
]


def monthly_transactions(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Transaction totals per month.

    The sums are taken per day before any join, which leaves one row per day
    and map task to exchange.  The distinct accounts need an exchange of
    (month, account) pairs; it carries those two columns and no sums, and it
    spreads out a month that has most of the rows.
    """
    months, names = ["Year", "MonthNumber"], ["MonthName", "Quarter"]
    days = part_of(calendar, calendar.select("DateKey", *months))
    per_day = fact.groupBy("DateKey").agg(
        F.sum("TransactionCount").alias("n"),
        *[F.sum(c).alias(c) for c in ("TransactionAmount", "InflowAmount", "OutflowAmount", "SignedAmount")],
    )
    summed = (
        # both sides have a row per day
        per_day.join(part_of(calendar, calendar.select("DateKey", *months, *names)), "DateKey")
        .groupBy(*months, *names)
        .agg(
            F.sum("n").alias("TotalTransactions"),
            total("TransactionAmount").alias("TotalTransactionAmount"),
            total("InflowAmount").alias("TotalInflow"),
            total("OutflowAmount").alias("TotalOutflow"),
            total("SignedAmount").alias("NetCashFlow"),
            ratio(F.sum("TransactionAmount"), F.sum("n")).alias("AverageTransactionAmount"),
        )
    )
    active = (
        lookup_join(
            fact.select("DateKey", "AccountKey"), days, "DateKey", "inner", row_id="AccountKey"
        )
        .groupBy(*months)
        .agg(F.count_distinct("AccountKey").alias("ActiveAccounts"))
    )
    # both have at most one row per month of the calendar
    return (
        summed.join(active, months)
        .select(
            *months, *names,
            year_month_label(*months).alias("YearMonthLabel"),
            "TotalTransactions", "ActiveAccounts", "TotalTransactionAmount", "TotalInflow",
            "TotalOutflow", "NetCashFlow", "AverageTransactionAmount",
        )
    )


def refresh_monthly(mart: DataFrame, fact: DataFrame, calendar: DataFrame, months: Sequence[int]) -> DataFrame:
    """The monthly mart after facts of ``months`` (YYYYMM) were added; the other months are carried over.

    ``fact`` has its partition column ``TransactionYear``, so only the folders of the years
    touched are read, and the distinct accounts of only these months are exchanged.
    """
    wanted = [int(m) for m in months]
    years = sorted({m // 100 for m in wanted})
    touched = fact.filter(F.col("TransactionYear").isin(years)).filter(
        F.floor(F.col("DateKey") / 100).isin(wanted))
    month = F.col("Year") * 100 + F.col("MonthNumber")
    fresh = monthly_transactions(touched, part_of(calendar, calendar.filter(month.isin(wanted))))
    return mart.filter(~month.isin(wanted)).unionByName(fresh)


def district_loans(fact: DataFrame, districts: DataFrame) -> DataFrame:
    """Loan totals per known district; the fact is summed before it meets the names.

    The distinct borrowers go through an exchange of their own that carries
    (district, account) pairs only.
    """
    summed = fact.groupBy("DistrictKey").agg(
        F.sum("LoanCount").alias("TotalLoans"),
        total("LoanAmount").alias("TotalLoanAmount"),
        ratio(F.sum("LoanAmount"), F.sum("LoanCount")).alias("AverageLoanAmount"),
        total("MonthlyPayment").alias("TotalMonthlyPayments"),
        total("ExpectedPaymentAmount").alias("TotalExpectedPaymentAmount"),
        F.sum("ProblemLoanCount").alias("ProblemLoans"),
        ratio(
            F.lit(100).cast("decimal(4,1)") * F.sum("ProblemLoanCount"),
            F.sum("LoanCount"),
            "decimal(6,2)",
        ).alias("ProblemLoanPercentage"),
    )
    borrowers = fact.groupBy("DistrictKey").agg(
        F.count_distinct("AccountKey").alias("BorrowingAccounts")
    )
    known = districts.filter(F.col("DistrictID") != K.UNKNOWN_ID).select(*DISTRICT_COLUMNS)
    return known.join(summed, "DistrictKey").join(borrowers, "DistrictKey").select(
        *DISTRICT_COLUMNS,
        "TotalLoans", "BorrowingAccounts", "TotalLoanAmount", "AverageLoanAmount",
        "TotalMonthlyPayments", "TotalExpectedPaymentAmount", "ProblemLoans",
        "ProblemLoanPercentage",
    )


def excluded_loans(fact: DataFrame, districts: DataFrame) -> DataFrame:
    """Loans the district mart leaves out because their district is unknown."""
    known = districts.filter(F.col("DistrictID") != K.UNKNOWN_ID).select("DistrictKey")
    per_district = fact.groupBy("DistrictKey").agg(F.sum("LoanCount").alias("n"))
    return per_district.join(known, "DistrictKey", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("ExcludedLoans")
    )


def riskiest_districts(mart: DataFrame, n: int = 10) -> DataFrame:
    """Districts with the highest share of problem loans."""
    return mart.orderBy(
        F.desc("ProblemLoanPercentage"), F.desc("TotalLoanAmount"), "DistrictKey"
    ).limit(n)


def first_months(mart: DataFrame, n: int = 12) -> DataFrame:
    return mart.orderBy("Year", "MonthNumber").limit(n)


def loans_by_status(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    """Loan totals per status, summed per key before the names are added."""
    summed = fact.groupBy("LoanStatusKey").agg(
        F.sum("LoanCount").alias("LoanCount"),
        total("LoanAmount").alias("TotalLoanAmount"),
        ratio(F.sum("LoanAmount"), F.count("LoanAmount")).alias("AverageLoanAmount"),
        total("ExpectedPaymentAmount").alias("TotalExpectedPaymentAmount"),
        F.sum("ProblemLoanCount").alias("ProblemLoanCount"),
    )
    names = ["LoanStatusCode", "LoanStatusDescription", "LoanStatusGroup", "ProblemFlag"]
    return (
        statuses.join(summed, "LoanStatusKey")
        .select(*names, *[c for c in summed.columns if c != "LoanStatusKey"])
        .orderBy("LoanStatusCode")
    )


def transactions_by_type(fact: DataFrame, types: DataFrame) -> DataFrame:
    """Transaction totals per type name and direction, largest first."""
    per_key = fact.groupBy("TransactionTypeKey").agg(
        F.count("*").alias("n"), F.sum("InflowAmount").alias("i"),
        F.sum("OutflowAmount").alias("o"), F.sum("SignedAmount").alias("s"),
    )
    return (
        types.join(per_key, "TransactionTypeKey")
        .groupBy("TransactionTypeName", "CashFlowDirection")
        .agg(
            F.sum("n").alias("TransactionRecords"),
            total("i").alias("TotalInflow"),
            total("o").alias("TotalOutflow"),
            total("s").alias("NetAmount"),
        )
        .orderBy(F.desc("TransactionRecords"), "TransactionTypeName", "CashFlowDirection")
    )


def loan_listing(fact: DataFrame, dims: Mapping[str, DataFrame], n: int = 100) -> DataFrame:
    """The first ``n`` loans by date with all their attributes.

    The ``n`` rows are chosen first (a top-n, no full sort) and written; the
    dimensions are then read only for them.
    """
    days = part_of(dims["DimDate"], dims["DimDate"].select(F.col("DateKey").alias("LoanDateKey"), "FullDate"))
    dated = lookup_join(fact, days, "LoanDateKey", "inner", row_id="LoanID")
    chosen = stage_table(dated.orderBy("FullDate", "LoanID").limit(n), "chosen")

    def attributes(dim: str, key: str, *names: str) -> DataFrame:
        wanted = dims[dim].select(key, *names)
        return wanted.join(F.broadcast(chosen.select(key).distinct()), key, "left_semi")

    listed = (
        chosen.join(attributes("DimAccount", "AccountKey", "AccountID"), "AccountKey", "left")
        .join(
            attributes("DimDistrict", "DistrictKey", "DistrictID", "DistrictName", "RegionName"),
            "DistrictKey", "left",
        )
        .join(
            attributes(
                "DimLoanStatus", "LoanStatusKey", "LoanStatusCode", "LoanStatusDescription",
                "LoanStatusGroup", "ProblemFlag",
            ),
            "LoanStatusKey", "left",
        )
    )
    return listed.select(
        "LoanKey", "LoanID", "LoanDateKey", F.col("FullDate").alias("LoanDate"),
        "AccountKey", "AccountID", "DistrictKey", "DistrictID", "DistrictName", "RegionName",
        "LoanStatusKey", "LoanStatusCode", "LoanStatusDescription", "LoanStatusGroup",
        "ProblemFlag", "LoanCount", "LoanAmount", "LoanDurationMonths", "MonthlyPayment",
        "ExpectedPaymentAmount", "ProblemLoanCount",
    ).orderBy("LoanDate", "LoanID")
