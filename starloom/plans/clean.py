"""Staged source tables to clean tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions import (
    age_band,
    clean_text,
    date_key,
    first_number,
    inflow,
    map_code,
    money,
    norm_code,
    outflow,
    signed,
    whole,
    year_diff,
)
from starloom.operators import latest_per_key, preferred_per_key
from starloom.operators.joins import lookup_join
from starloom.session import is_one_per, one_per, part_of
from starloom.sources.staging import AUDIT

_STATUS = [r for r in K.LOAN_STATUS if r[0] != K.UNKNOWN_CODE]


def account_clean(
    account: DataFrame, source_system: str, observed_to: dt.date = K.OBSERVATION_END
) -> DataFrame:
    """One row per account: frequency translated, date key, age and age band."""
    latest = latest_per_key(account, "account_id", AUDIT)
    rows = latest.select(
        F.col("account_id").alias("AccountID"),
        F.coalesce("district_id", F.lit(K.UNKNOWN_ID)).alias("DistrictID"),
        map_code("frequency", K.STATEMENT_FREQUENCY, K.UNKNOWN_TEXT).alias("StatementFrequency"),
        F.col("date").alias("AccountOpenDate"),
        date_key("date").alias("AccountOpenDateKey"),
        year_diff("date", observed_to).alias("AccountAgeYears"),
        age_band("date", observed_to).alias("AccountAgeGroup"),
        F.lit(source_system).alias("SourceSystem"),
        AUDIT,
    )
    return one_per(rows, "AccountID")


def district_clean(district: DataFrame) -> DataFrame:
    """One row per district: names cleaned, newest available yearly figures."""
    latest = latest_per_key(district, "district_id", AUDIT)
    return latest.select(
        F.col("district_id").alias("DistrictID"),
        clean_text("district_name").alias("DistrictName"),
        clean_text("region_name").alias("RegionName"),
        F.col("population").alias("Population"),
        whole("average_salary").alias("AverageSalary"),
        first_number(
            lambda c: F.col(c).cast("decimal(5,2)"),
            "unemployment_rate_1996", "unemployment_rate_1995",
        ).alias("UnemploymentMeasure"),
        F.col("entrepreneurs_per_1000_residents").alias("EntrepreneurMeasure"),
        F.coalesce("crimes_committed_1996", "crimes_committed_1995").alias("CrimeMeasure"),
        AUDIT,
    )


def preferred_disposition(disp: DataFrame) -> DataFrame:
    """One disposition per client: an owner if there is one, else the lowest id."""
    owner_first = F.when(norm_code("type") == "OWNER", 1).otherwise(2)
    return preferred_per_key(disp, "client_id", [owner_first, "disp_id"])


def client_clean(
    client: DataFrame,
    disp: DataFrame,
    districts: DataFrame,
    observed_to: dt.date = K.OBSERVATION_END,
) -> DataFrame:
    """One row per client with its preferred disposition and a valid district.

    Both sides are reduced to one row per client before they meet, so a client
    with very many dispositions never multiplies rows.
    """
    clients = latest_per_key(client, "client_id", AUDIT)
    chosen = preferred_disposition(disp).select("client_id", "disp_id", "account_id", "type")
    known = districts.select(F.col("DistrictID").alias("district_id")).withColumn(
        "_known", F.lit(True)
    )
    joined = clients.join(chosen, "client_id", "left")
    joined = lookup_join(
        joined, known, "district_id", "left", row_id="client_id", measure=client
    )
    return joined.select(
        F.col("client_id").alias("ClientID"),
        F.when(F.col("_known"), F.col("district_id"))
        .otherwise(F.lit(K.UNKNOWN_ID))
        .alias("DistrictID"),
        map_code("type", K.CLIENT_ROLE, K.UNKNOWN_TEXT).alias("ClientRole"),
        F.col("disp_id").alias("DispositionID"),
        F.col("account_id").alias("AccountID"),
        F.col("birth_number").alias("BirthDate"),
        year_diff("birth_number", observed_to).alias("AgeAtDatasetEnd"),
        AUDIT,
    )


def loan_clean(loan: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per valid loan: status translated, district taken from the account."""
    latest = latest_per_key(loan, "loan_id", AUDIT).filter(
        (F.col("amount") > 0) & (F.col("duration") > 0) & (F.col("payments") > 0)
    )
    district = part_of(accounts, accounts.select(
        F.col("AccountID").alias("account_id"), F.col("DistrictID").alias("_district")
    ))
    joined = lookup_join(
        latest, district, "account_id", "left", row_id="loan_id", measure=loan
    )
    return joined.select(
        F.col("loan_id").alias("LoanID"),
        F.col("account_id").alias("AccountID"),
        F.coalesce("_district", F.lit(K.UNKNOWN_ID)).alias("DistrictID"),
        F.col("date").alias("LoanDate"),
        date_key("date").alias("LoanDateKey"),
        map_code("status", {c: c for c, *_ in _STATUS}, K.UNKNOWN_CODE).alias("LoanStatusCode"),
        map_code("status", {c: d for c, d, _, _ in _STATUS}, K.LOAN_STATUS[0][1]).alias(
            "LoanStatusDescription"
        ),
        map_code("status", {c: g for c, _, g, _ in _STATUS}, K.UNKNOWN_TEXT).alias(
            "LoanStatusGroup"
        ),
        money("amount").alias("LoanAmount"),
        F.col("duration").alias("LoanDurationMonths"),
        money("payments").alias("MonthlyPayment"),
        money(F.col("payments") * F.col("duration")).alias("ExpectedPaymentAmount"),
        F.lit(1).alias("LoanCount"),
        map_code("status", {c: p for c, _, _, p in _STATUS}, 0).alias("ProblemLoanCount"),
        AUDIT,
    )


def transaction_clean(trans: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per complete transaction of a known account, with its measures."""
    latest = latest_per_key(trans, "trans_id", AUDIT).filter(
        F.col("account_id").isNotNull() & F.col("date").isNotNull() & F.col("amount").isNotNull()
    )
    district = part_of(
        accounts, accounts.select(F.col("AccountID").alias("account_id"), "DistrictID")
    )
    joined = lookup_join(
        latest, district, "account_id", "inner", row_id="trans_id", measure=trans
    )
    types = [c for c, *_ in K.TRANSACTION_TYPE if c != K.UNKNOWN_CODE]
    rows = joined.select(
        F.col("trans_id").alias("TransactionID"),
        F.col("account_id").alias("AccountID"),
        "DistrictID",
        F.col("date").alias("TransactionDate"),
        date_key("date", missing=None).alias("DateKey"),
        map_code("type", {c: c for c in types}, K.UNKNOWN_CODE).alias("TransactionTypeCode"),
        norm_code("operation").alias("OperationCode"),
        money("amount").alias("TransactionAmount"),
        inflow("type", "amount").alias("InflowAmount"),
        outflow("type", "amount").alias("OutflowAmount"),
        signed("type", "amount").alias("SignedAmount"),
        money("balance").alias("BalanceAfterTransaction"),
        norm_code("k_symbol").alias("PurposeCode"),
        F.lit(1).alias("TransactionCount"),
        AUDIT,
    )
    # an account that occurs twice would double its transactions
    return one_per(rows, "TransactionID") if is_one_per(accounts, "AccountID") else rows
