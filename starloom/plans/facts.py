"""Fact loads: key resolution, upsert, incremental append, rebuild.

Call these on stage tables (published or written with ``stage_table``): sizes
and hot keys are measured by reading single columns of the inputs.  A fact's
dimensions are joined once; kept rows, unmatched counts and keys come from what
that join wrote.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import constants as K
from starloom import schemas as S
from starloom.functions import date_key, money, norm_code, try_int, try_money
from starloom.operators import (
    ACTION,
    DayLookup,
    KeyLookup,
    action_counts,
    assign_keys,
    max_key,
    new_rows,
    new_rows_by_key,
    preferred_per_key,
    require,
    require_unique,
    resolve_keys,
    resolve_once,
    upsert,
)
from starloom.operators.joins import lookup_join
from starloom.operators.merge import merge_into, roomy
from starloom.session import is_one_per, known_size, part_of, stage_table
from starloom.sources.snapshot import BUCKET_ROWS, SnapshotTable

Dims = Mapping[str, DataFrame]

LOAN_COLUMNS = [f.name for f in S.FACT_LOAN.fields]
LOAN_ATTRIBUTES = [c for c in LOAN_COLUMNS if c not in ("LoanKey", "LoanID")]
TRANSACTION_COLUMNS = [f.name for f in S.FACT_TRANSACTION.fields]
LOAN_DIMS = [
    ("DimAccount", "AccountKey"), ("DimDistrict", "DistrictKey"),
    ("DimLoanStatus", "LoanStatusKey"),
]
#: what a loan brings to the fact as it is
LOAN_MEASURES = [c for c in LOAN_COLUMNS if c not in ("LoanKey", *(k for _, k in LOAN_DIMS))]
TRANSACTION_DIMS = [
    ("DimAccount", "AccountKey"), ("DimDistrict", "DistrictKey"),
    ("DimTransactionType", "TransactionTypeKey"), ("DimOperation", "OperationKey"),
]
#: what a transaction brings to the fact as it is, and what its keys are looked up by
TRANSACTION_MEASURES = [c for c in TRANSACTION_COLUMNS if c not in ("TransactionKey", *(k for _, k in TRANSACTION_DIMS))]
TRANSACTION_CODES = ["AccountID", "DistrictID", "TransactionTypeCode", "OperationCode"]
YEAR = "TransactionYear"


@dataclass(frozen=True)
class FactLoad:
    """Rows of a load, and how many source rows each lookup did not match."""

    rows: DataFrame
    unmatched: DataFrame


def _current(dim_account: DataFrame) -> DataFrame:
    return part_of(dim_account, dim_account.filter("IsCurrent"))


def _date_lookup(dims: Dims, fact_column: str) -> KeyLookup:
    # a fact without a calendar day has no place in any report by date
    return DayLookup(dims["DimDate"], fact_column, "DateKey", "DateKey", "_date", "drop")


def loan_lookups(dims: Dims, on_missing: str) -> list[KeyLookup]:
    return [
        _date_lookup(dims, "LoanDateKey"),
        KeyLookup(
            _current(dims["DimAccount"]), "AccountID", "AccountID", "AccountKey",
            on_missing=on_missing,
        ),
        KeyLookup(
            dims["DimDistrict"], "DistrictID", "DistrictID", "DistrictKey", on_missing=on_missing
        ),
        KeyLookup(
            dims["DimLoanStatus"], "LoanStatusCode", "LoanStatusCode", "LoanStatusKey",
            on_missing=on_missing,
        ),
    ]


def transaction_lookups(dims: Dims, on_missing: str) -> list[KeyLookup]:
    return [
        _date_lookup(dims, "DateKey"),
        KeyLookup(
            _current(dims["DimAccount"]), "AccountID", "AccountID", "AccountKey",
            on_missing=on_missing,
        ),
        KeyLookup(
            dims["DimDistrict"], "DistrictID", "DistrictID", "DistrictKey", on_missing=on_missing
        ),
        KeyLookup(
            dims["DimTransactionType"], "TransactionTypeCode", "TransactionTypeCode",
            "TransactionTypeKey", on_missing=on_missing,
        ),
        KeyLookup(
            dims["DimOperation"], "OperationCode", "OperationCode", "OperationKey",
            on_missing=on_missing,
        ),
    ]


def require_unknown_members(dims: Dims, pairs) -> None:
    """Stop unless every dimension has its key 0, which unmatched rows will use."""
    for name, key in pairs:
        missing = (
            dims[name].filter(F.col(key) == K.UNKNOWN_KEY).agg(F.count("*").alias("n"))
        ).filter("n = 0")
        require(missing, f"{key} 0 is missing from {name}")


def resolve_loans(loans: DataFrame, dims: Dims, on_missing: str = "unknown") -> FactLoad:
    """Clean loans with surrogate keys, and the unmatched counts."""
    lookups = loan_lookups(dims, on_missing)
    rows, unmatched = resolve_once(loans, lookups, row_id="LoanID", keep=LOAN_MEASURES)
    return FactLoad(part_of(rows, rows.select(*[c for c in LOAN_COLUMNS if c != "LoanKey"])), unmatched)


def upsert_loans(target: DataFrame, load: FactLoad) -> DataFrame:
    """Fact upsert: known loans overwritten, new ones appended with new keys.

    The result has the action column and is published as a new snapshot.
    """
    return upsert(target, load.rows, "LoanID", LOAN_ATTRIBUTES, "LoanKey", check_source=False)


def prepare_loans(loan: DataFrame) -> DataFrame:
    """Source loans for the rebuild: bad numbers become 0, no loan is rejected."""
    zero = F.lit(0).cast("decimal(18,2)")
    complete = (
        F.col("loan_id").isNotNull() & F.col("account_id").isNotNull() & F.col("date").isNotNull()
    )
    prepared = loan.filter(complete).select(
        F.col("loan_id").alias("LoanID"),
        F.col("account_id").alias("AccountID"),
        date_key("date", missing=None).alias("LoanDateKey"),
        norm_code("status").alias("LoanStatusCode"),
        F.lit(1).alias("LoanCount"),
        F.coalesce(try_money("amount"), zero).alias("LoanAmount"),
        F.coalesce(try_int("duration"), F.lit(0)).alias("LoanDurationMonths"),
        F.coalesce(try_money("payments"), zero).alias("MonthlyPayment"),
    )
    return prepared.withColumn(
        "ExpectedPaymentAmount", money(F.col("LoanDurationMonths") * F.col("MonthlyPayment"))
    )


def account_map(account: DataFrame, dims: Dims) -> DataFrame:
    """Account id → account key and district key, 0 where either is unknown.

    Both facts about an account are settled on the small side, so the loans
    look their account up once.
    """
    current = _current(dims["DimAccount"]).select("AccountID", "AccountKey")
    source = account.select(F.col("account_id").alias("AccountID"), "district_id")
    districts = dims["DimDistrict"].select(
        F.col("DistrictID").alias("district_id"), F.col("DistrictKey")
    )
    located = lookup_join(source, districts, "district_id", "left", row_id="AccountID")
    return current.join(located, "AccountID", "full_outer").select(
        "AccountID",
        F.coalesce("AccountKey", F.lit(K.UNKNOWN_KEY)).alias("AccountKey"),
        F.coalesce("DistrictKey", F.lit(K.UNKNOWN_KEY)).alias("DistrictKey"),
    )


def rebuild_loans(loan: DataFrame, account: DataFrame, dims: Dims) -> DataFrame:
    """The whole loan fact from the source, unmatched references at key 0.

    Only a date outside the calendar removes a loan.
    """
    require_unknown_members(dims, LOAN_DIMS)
    require_unique(loan.filter("loan_id IS NOT NULL"), "loan_id")
    require_unique(account, "account_id")
    lookups = [
        _date_lookup(dims, "LoanDateKey"),
        KeyLookup(
            dims["DimLoanStatus"], "LoanStatusCode", "LoanStatusCode", "LoanStatusKey",
            carry=["ProblemFlag"],
        ),
    ]
    keyed = resolve_keys(prepare_loans(loan), lookups, row_id="LoanID")
    placed = lookup_join(
        keyed, stage_table(account_map(account, dims), "account_map"), "AccountID", "left",
        row_id="LoanID", measure=loan.select(F.col("account_id").alias("AccountID")),
    )
    rows = placed.withColumn(
        "ProblemLoanCount", F.when(F.col("ProblemFlag"), 1).otherwise(0)
    ).withColumns(
        {k: F.coalesce(k, F.lit(K.UNKNOWN_KEY)) for k in ("AccountKey", "DistrictKey")}
    )
    return assign_keys(
        rows.select(*[c for c in LOAN_COLUMNS if c != "LoanKey"]), "LoanID", "LoanKey",
        max_rows=loan.count(),
    ).select(*LOAN_COLUMNS)


def resolve_transactions(
    transactions: DataFrame, dims: Dims, on_missing: str = "unknown",
    rows: int | None = None, measure: DataFrame | None = None,
) -> FactLoad:
    """Clean transactions with surrogate keys, and the unmatched counts; ``rows`` and ``measure`` are as in ``resolve_once``."""
    lookups = transaction_lookups(dims, on_missing)
    found, unmatched = resolve_once(
        transactions, lookups, row_id="TransactionID", keep=TRANSACTION_MEASURES, rows=rows, measure=measure
    )
    return FactLoad(found.select(*[c for c in TRANSACTION_COLUMNS if c != "TransactionKey"]), unmatched)


def append_transactions(
    target: DataFrame | SnapshotTable,
    transactions: DataFrame,
    dims: Dims,
    on_missing: str = "unknown",
    increment: bool = False,
    last_key: int | None = None,
) -> FactLoad:
    """The rows to append: transactions the fact does not have, with keys.

    Of rows with one id in ``transactions`` one counts; rows without an id are
    left out.  Transactions noted to have one row per id (``session.one_per``), which
    are a stored table or some of its rows, are taken as they lie.  Known ids are
    removed first, so a rerun looks nothing up and appends nothing.

    ``target`` may be the published table: then only the parts of it are read
    that can hold an id of the batch, and in those the range of the batch's
    ids; a batch of new ids reads none.  Append the rows with ``since`` the table's
    version before this call.  For a frame, ``increment`` says the
    transactions are few next to the fact, whose ids, all of them, are then not
    shuffled, and ``last_key`` is its largest key, if known.
    """
    unique = is_one_per(transactions, "TransactionID")
    offered = transactions if unique else preferred_per_key(transactions, "TransactionID", [])
    offered = offered.select(*TRANSACTION_MEASURES, *TRANSACTION_CODES)
    if isinstance(target, SnapshotTable):
        last_key = target.top()
        offered = offered if unique else stage_table(offered, "offered")
        known = target.holding(offered, "TransactionID")
    else:
        if last_key is None:
            last_key = max_key(target, "TransactionKey")
        known = target if last_key else None
        if not unique:
            if known is not None and not increment:
                # both sides lie by id after the first step
                offered, known = new_rows(offered, known, "TransactionID"), None
            offered = stage_table(offered, "offered")
    n = known_size(offered)[0] if known_size(offered) else offered.count()
    fresh = offered
    if known is not None:
        fresh, n = new_rows_by_key(offered, known, "TransactionID", n)
    load = resolve_transactions(fresh, dims, on_missing, rows=n, measure=offered)
    rows = assign_keys(
        load.rows, "TransactionID", "TransactionKey", last_key + 1, max_rows=n, stored=True,
    )
    return FactLoad(rows.select(*TRANSACTION_COLUMNS), load.unmatched)


def transaction_table(spark: SparkSession, path: str) -> SnapshotTable:
    """The published transaction fact: a folder per year, the range of ids known for each increment."""
    return SnapshotTable(spark, path, [YEAR], key="TransactionKey", ids="TransactionID")


def loan_table(spark: SparkSession, path: str, bucket_rows: int = BUCKET_ROWS) -> SnapshotTable:
    """The published loan fact, in hash buckets of the loan."""
    return SnapshotTable(spark, path, key="LoanKey", bucket_by="LoanID", bucket_rows=bucket_rows)


def merge_loans(table: SnapshotTable, load: FactLoad) -> DataFrame:
    """Fact upsert into the published table; only buckets with new or changed loans are written.

    Returns the row of counts.  A table that outgrew its buckets is published anew.
    """
    if not table.exists() or not roomy(table, known_size(load.rows)[0]):
        target = table.read() if table.exists() else table.spark.createDataFrame([], S.FACT_LOAN)
        since = table.version()
        result = stage_table(upsert_loans(target, load), "loans")
        counts = stage_table(action_counts(result), "loan_counts")
        table.publish(result.drop(ACTION), known_size(result)[0], since)
        return counts
    return merge_into(table, load.rows, "LoanID", LOAN_ATTRIBUTES, "LoanKey", check_source=False)


def with_year(fact: DataFrame) -> DataFrame:
    """The partition column of the transaction fact."""
    return fact.select("*", F.floor(F.col("DateKey") / 10000).cast("int").alias(YEAR))
