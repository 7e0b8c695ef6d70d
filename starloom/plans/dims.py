"""Dimensions: calendar, lookups, districts, accounts, clients; the card table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import constants as K
from starloom import schemas as S
from starloom.functions import (
    century_timestamp,
    clean_text,
    date_key,
    first_number,
    map_code,
    norm_code,
    try_int,
    try_rate,
)
from starloom.operators import (
    as_current,
    days_of,
    insert_new,
    new_rows,
    preferred_per_key,
    upsert,
)
from starloom.operators.joins import lookup_join
from starloom.operators.upsert import ACTION
from starloom.session import local_rows, part_of, stage_table
from starloom.sources.files import constant_table
from starloom.sources.staging import AUDIT

#: the attributes a load overwrites, per dimension
DISTRICT_ATTRIBUTES = [
    "DistrictName", "RegionName", "Population", "AverageSalary", "UnemploymentMeasure",
    "EntrepreneurMeasure", "CrimeMeasure",
]
ACCOUNT_ATTRIBUTES = ["AccountOpenDate", "StatementFrequency", "AccountAgeGroup", "SourceSystem"]
CLIENT_ATTRIBUTES = ["DistrictKey", "ClientRole"]

#: the unknown member of each dimension (fixed values)
UNKNOWN_MEMBERS: dict[str, dict[str, object]] = {
    "AccountKey": {
        "AccountID": K.UNKNOWN_ID, "AccountOpenDate": K.UNKNOWN_DATE_KEY,
        "StatementFrequency": K.UNKNOWN_TEXT, "AccountAgeGroup": K.UNKNOWN_TEXT,
        "SourceSystem": K.UNKNOWN_TEXT, "EffectiveFrom": K.BEGINNING,
        "EffectiveTo": K.OPEN_END, "IsCurrent": True,
    },
    "DistrictKey": {
        "DistrictID": K.UNKNOWN_ID, "DistrictName": K.UNKNOWN_TEXT, "RegionName": K.UNKNOWN_TEXT,
    },
    "LoanStatusKey": {
        "LoanStatusCode": K.UNKNOWN_CODE, "LoanStatusDescription": "Unknown Loan Status",
        "LoanStatusGroup": K.UNKNOWN_TEXT, "ProblemFlag": False,
    },
    "TransactionTypeKey": {
        "TransactionTypeCode": K.UNKNOWN_CODE, "TransactionTypeName": "Unknown Transaction Type",
        "CashFlowDirection": K.UNKNOWN_TEXT,
    },
    "OperationKey": {
        "OperationCode": K.UNKNOWN_CODE, "OperationDescription": "Unknown Operation",
        "OperationGroup": K.UNKNOWN_TEXT,
    },
}


def calendar_days(start: dt.date, end: dt.date) -> int:
    return (end - start).days + 1


def calendar_range(
    dates: Sequence[tuple[DataFrame, str]], start: dt.date = K.CALENDAR_START
) -> tuple[dt.date, dt.date]:
    """Whole years that hold every date of the columns, and ``start``, the day of facts without a date.

    One minimum and one maximum of all; only the date columns are read.
    """
    columns = [frame.select(F.col(column).cast("date").alias("d")) for frame, column in dates]
    seen = reduce(DataFrame.unionByName, columns).agg(F.min("d").alias("a"), F.max("d").alias("b")).first()
    found = [start, *(d for d in seen if d is not None)]
    return dt.date(min(found).year, 1, 1), dt.date(max(found).year, 12, 31)


def dim_date(
    spark: SparkSession, start: dt.date = K.CALENDAR_START, end: dt.date = K.CALENDAR_END
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    day, days = F.col("FullDate"), calendar_days(start, end)
    days = spark.range(0, days, numPartitions=1 + days // 1_000_000).select(
        F.date_add(F.to_date(F.lit(start.isoformat())), F.col("id").cast("int")).alias("FullDate")
    )
    return days.select(
        date_key(day).alias("DateKey"),
        "FullDate",
        F.dayofmonth(day).alias("DayNumber"),
        F.date_format(day, "EEEE").alias("DayName"),
        F.weekofyear(day).alias("WeekNumber"),
        F.month(day).alias("MonthNumber"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.quarter(day).alias("Quarter"),
        F.year(day).alias("Year"),
        F.lpad(F.month(day).cast("string"), 2, "0").alias("YearMonth"),
    )


def stored_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The calendar as a stage table, known to have no gap."""
    low, high = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    return days_of(stage_table(dim_date(spark, start, end), "calendar"), "DateKey", low, high)


# --- lookups from constants -------------------------------------------------


def loan_status_values(spark: SparkSession) -> DataFrame:
    rows = [(c, d, g, bool(p)) for c, d, g, p in K.LOAN_STATUS]
    return constant_table(
        spark, rows,
        "LoanStatusCode string, LoanStatusDescription string, LoanStatusGroup string,"
        "ProblemFlag boolean",
    )


def transaction_type_values(spark: SparkSession) -> DataFrame:
    return constant_table(
        spark, K.TRANSACTION_TYPE,
        "TransactionTypeCode string, TransactionTypeName string, CashFlowDirection string",
    )


def operation_values(spark: SparkSession) -> DataFrame:
    return constant_table(
        spark, K.OPERATION,
        "OperationCode string, OperationDescription string, OperationGroup string",
    )


def empty_dim(spark: SparkSession, schema, key: str) -> DataFrame:
    """A new dimension that holds only its unknown member."""
    values = {**UNKNOWN_MEMBERS[key], key: K.UNKNOWN_KEY}
    return local_rows(spark, [[values.get(f.name) for f in schema.fields]], schema)


def load_lookup(target: DataFrame, values: DataFrame, code: str, key: str) -> DataFrame:
    """Upsert a lookup dimension from its value table (unknown member included)."""
    attributes = [c for c in values.columns if c != code]
    return upsert(target, values, code, attributes, key, check_source=False)


# --- lookups from the codes that occur --------------------------------------


def distinct_codes(source: DataFrame, column: str, code: str) -> DataFrame:
    """The normalised codes of a column; repeated ones are merged map-side."""
    return source.select(norm_code(column).alias(code)).distinct()


def describe_loan_status(codes: DataFrame) -> DataFrame:
    code = F.col("LoanStatusCode")
    return codes.select(
        code,
        map_code(code, {c: d for c, d, _, _ in K.LOAN_STATUS}, K.OTHER_LOAN_STATUS).alias(
            "LoanStatusDescription"
        ),
        map_code(code, {c: g for c, _, g, _ in K.LOAN_STATUS}, K.UNKNOWN_TEXT).alias(
            "LoanStatusGroup"
        ),
        map_code(code, {c: bool(p) for c, _, _, p in K.LOAN_STATUS}, False).alias("ProblemFlag"),
    )


def describe_transaction_type(codes: DataFrame) -> DataFrame:
    code = F.col("TransactionTypeCode")
    known = [*K.TRANSACTION_TYPE, *K.TRANSACTION_TYPE_ENGLISH]
    return codes.select(
        code,
        map_code(code, {c: n for c, n, _ in known}, K.OTHER_TRANSACTION_TYPE).alias(
            "TransactionTypeName"
        ),
        map_code(code, {c: d for c, _, d in known}, K.UNKNOWN_TEXT).alias("CashFlowDirection"),
    )


def describe_operation(codes: DataFrame) -> DataFrame:
    code = F.col("OperationCode")
    known = [*K.OPERATION, *K.OPERATION_ENGLISH]
    return codes.select(
        code,
        map_code(code, {c: d for c, d, _ in known}, K.OTHER_OPERATION).alias(
            "OperationDescription"
        ),
        map_code(code, {c: g for c, _, g in known}, K.UNKNOWN_TEXT).alias("OperationGroup"),
    )


def dim_from_codes(
    target: DataFrame, source: DataFrame, column: str, code: str, key: str, describe
) -> DataFrame:
    """Add the codes of ``source`` the dimension does not have yet.

    ``describe`` turns a frame of codes into the dimension's attributes.  The
    unknown code already has key 0.
    """
    codes = distinct_codes(source, column, code).filter(F.col(code) != K.UNKNOWN_CODE)
    return insert_new(target, describe(codes), code, key).drop(ACTION)


# --- districts, accounts, clients -------------------------------------------


def district_from_text(district: DataFrame) -> DataFrame:
    """District attributes from columns that may hold text or junk.

    Whatever does not convert is NULL; yearly figures fall back one year; rows
    without a numeric id are dropped.
    """
    salary = F.round(F.trim(F.col("average_salary").cast("string")).try_cast("decimal(18,2)"), 0)
    return district.select(
        try_int("district_id").alias("DistrictID"),
        clean_text("district_name").alias("DistrictName"),
        clean_text("region_name").alias("RegionName"),
        try_int("population").alias("Population"),
        salary.try_cast("int").alias("AverageSalary"),
        first_number(try_rate, "unemployment_rate_1996", "unemployment_rate_1995").alias(
            "UnemploymentMeasure"
        ),
        try_int("entrepreneurs_per_1000_residents").alias("EntrepreneurMeasure"),
        first_number(try_int, "crimes_committed_1996", "crimes_committed_1995").alias(
            "CrimeMeasure"
        ),
    ).filter(F.col("DistrictID").isNotNull())


def dim_district(target: DataFrame, district: DataFrame) -> DataFrame:
    """Add the districts the dimension does not have yet, straight from the source."""
    return insert_new(target, district_from_text(district), "DistrictID", "DistrictKey").drop(
        ACTION
    )


def unknown_member(column: str) -> Column:
    return F.col(column) == K.UNKNOWN_ID


def load_district(target: DataFrame, districts: DataFrame) -> DataFrame:
    """Upsert the district dimension from the clean table."""
    return upsert(
        target, districts, "DistrictID", DISTRICT_ATTRIBUTES, "DistrictKey",
        protect=unknown_member("DistrictID"),
    )


def account_source(accounts: DataFrame) -> DataFrame:
    """Clean accounts as current rows; a new account is valid from the day it was opened."""
    source = accounts.select(
        "AccountID",
        F.col("AccountOpenDateKey").alias("AccountOpenDate"),
        "StatementFrequency", "AccountAgeGroup", "SourceSystem",
        F.col("AccountOpenDate").alias("_opened"),
    )
    return as_current(part_of(accounts, source), "_opened")


def load_account(target: DataFrame, accounts: DataFrame) -> DataFrame:
    """Upsert current accounts."""
    return upsert(
        target, account_source(accounts), "AccountID", ACCOUNT_ATTRIBUTES, "AccountKey",
        protect=unknown_member("AccountID"), scope=F.col("IsCurrent"),
    )


def client_source(clients: DataFrame, districts: DataFrame) -> DataFrame:
    """Clean clients as current rows; a new client is valid from the day of the load.

    Clients whose district is not in the dimension are left out, as an unknown
    district is a row of the dimension.
    """
    source = lookup_join(
        clients.select("ClientID", "DistrictID", "ClientRole", AUDIT),
        districts.select("DistrictID", "DistrictKey"),
        "DistrictID", "inner", row_id="ClientID",
    )
    return as_current(source, AUDIT)


def load_client(target: DataFrame, clients: DataFrame, districts: DataFrame) -> DataFrame:
    """Upsert current clients."""
    return upsert(
        target, client_source(clients, districts), "ClientID", CLIENT_ATTRIBUTES, "ClientKey",
        scope=F.col("IsCurrent"),
    )


# --- cards -------------------------------------------------------------------


def card_rows(cards: DataFrame, century: str = "19") -> DataFrame:
    """Typed card rows from the JSON records."""
    return cards.select(
        "card_id", "disp_id", F.col("type").alias("card_type"),
        century_timestamp("issued", century).alias("issued"),
    )


def load_cards(target: DataFrame, cards: DataFrame, century: str = "19") -> DataFrame:
    """The cards to append: those whose id the table does not have yet, one row per id."""
    return new_rows(preferred_per_key(card_rows(cards, century), "card_id", []), target, "card_id")


def new_dimensions(spark: SparkSession) -> Mapping[str, DataFrame]:
    """Every dimension with nothing but its unknown member (clients: empty)."""
    return {
        "DimDistrict": empty_dim(spark, S.DIM_DISTRICT, "DistrictKey"),
        "DimAccount": empty_dim(spark, S.DIM_ACCOUNT, "AccountKey"),
        "DimClient": spark.createDataFrame([], S.DIM_CLIENT),
        "DimLoanStatus": empty_dim(spark, S.DIM_LOAN_STATUS, "LoanStatusKey"),
        "DimTransactionType": empty_dim(spark, S.DIM_TRANSACTION_TYPE, "TransactionTypeKey"),
        "DimOperation": empty_dim(spark, S.DIM_OPERATION, "OperationKey"),
    }


def status_rank(code: Column | str, order: Sequence[str] = ("UNKNOWN", "A", "B", "C", "D")) -> Column:
    """Position of a code in a fixed report order; others come last."""
    return map_code(code, {c: i for i, c in enumerate(order)}, len(order))
