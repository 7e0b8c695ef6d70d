"""Keys, unknown members, lookups, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.bank import Bank
from catalogue.checks import norm, sum2
from catalogue.registry import query
from catalogue.roles import role, table
from starloom import constants as K
from starloom import schemas as S
from starloom.functions import norm_code
from starloom.operators import (
    action_counts,
    assign_keys,
    ensure_unknown,
    insert_new,
    update_matched,
)
from starloom.operators.upsert import ACTION
from starloom.plans import dims, validation
from starloom.session import stage_table

# the districts and accounts loaded earlier, for the upserts
LOADED_REGIONS = ["AFRICA", "AMERICA", "EUROPE"]

EARLIER_DISTRICT = """
    SELECT 0 AS DistrictKey, -1 AS DistrictID, 'Unknown' AS DistrictName, 'Unknown' AS RegionName,
           NULL AS Population, NULL AS AverageSalary, CAST(NULL AS DECIMAL(5,2)) AS UnemploymentMeasure,
           NULL AS EntrepreneurMeasure, NULL AS CrimeMeasure
    UNION ALL
    SELECT CAST(row_number() OVER (ORDER BY DistrictID) AS INTEGER), DistrictID, 'Old name', RegionName, 1,
           NULL, NULL, NULL, NULL
    FROM district_clean WHERE RegionName IN ('AFRICA', 'AMERICA', 'EUROPE')"""

UPSERTED_DISTRICT = f"""
    old AS ({EARLIER_DISTRICT}),
    fresh AS (SELECT CAST((SELECT max(DistrictKey) FROM old) + row_number() OVER (ORDER BY DistrictID) AS INTEGER)
                         AS DistrictKey, * EXCLUDE (ETL_LoadDateTime)
              FROM district_clean WHERE DistrictID NOT IN (SELECT DistrictID FROM old)),
    result AS (
        SELECT o.DistrictKey, s.* EXCLUDE (ETL_LoadDateTime), 'updated' AS "_action"
        FROM old o JOIN district_clean s USING (DistrictID)
        UNION ALL SELECT *, 'kept' FROM old WHERE DistrictID NOT IN (SELECT DistrictID FROM district_clean)
        UNION ALL SELECT *, 'inserted' FROM fresh)"""


def _earlier_districts(bank: Bank):
    """The dimension as an earlier load left it: some regions, other values."""
    old = bank.district_clean.filter(F.col("RegionName").isin(LOADED_REGIONS)).select(
        "DistrictID", F.lit("Old name").alias("DistrictName"), "RegionName",
        F.lit(1).alias("Population"),
    )
    empty = dims.empty_dim(bank.spark, S.DIM_DISTRICT, "DistrictKey")
    return stage_table(insert_new(empty, old, "DistrictID", "DistrictKey").drop(ACTION))


@query("""SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1000 AS OrderRowKey, o_orderkey,
                 o_orderdate, o_totalprice FROM orders""")
def surrogate_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return assign_keys(orders, ["o_orderdate", "o_orderkey"], "OrderRowKey", start=1001, stored=True)


@query("""SELECT n_nationkey + 1 AS NationKey, n_nationkey AS NationID, n_name AS NationName,
                 count(c_custkey) AS Customers
          FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
          UNION ALL SELECT 0, -1, 'Unknown', NULL""")
def unknown_member(spark, sf_dir):
    """Restoring the unknown member twice leaves one."""
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("Customers")
    )
    nations = table(spark, sf_dir, "nation").join(
        customers, F.col("n_nationkey") == F.col("c_nationkey"), "left"
    )
    dim = nations.select(
        (F.col("n_nationkey") + 1).alias("NationKey"),
        F.col("n_nationkey").alias("NationID"),
        F.col("n_name").alias("NationName"),
        F.coalesce("Customers", F.lit(0)).alias("Customers"),
    )
    row = {"NationID": K.UNKNOWN_ID, "NationName": K.UNKNOWN_TEXT}
    return ensure_unknown(ensure_unknown(dim, "NationKey", row), "NationKey", row)


@query(f"WITH {UPSERTED_DISTRICT} SELECT * FROM result")
def upsert_type1(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return dims.load_district(_earlier_districts(bank), bank.district_clean)


@query(f"""WITH {UPSERTED_DISTRICT}
           SELECT count(*) FILTER ("_action" = 'updated') AS UpdatedRows,
                  count(*) FILTER ("_action" = 'inserted') AS InsertedRows,
                  count(*) FILTER ("_action" = 'kept') AS KeptRows FROM result""")
def upsert_counts(spark, sf_dir):
    return action_counts(upsert_type1(spark, sf_dir))


@query(f"""WITH old AS ({EARLIER_DISTRICT})
           SELECT o.DistrictKey, o.DistrictID, coalesce(s.DistrictName, o.DistrictName) AS DistrictName,
                  coalesce(s.RegionName, o.RegionName) AS RegionName, o.Population,
                  CAST(o.AverageSalary AS INTEGER) AS AverageSalary, o.UnemploymentMeasure,
                  CAST(o.EntrepreneurMeasure AS INTEGER) AS EntrepreneurMeasure,
                  CAST(o.CrimeMeasure AS INTEGER) AS CrimeMeasure,
                  CASE WHEN s.DistrictID IS NULL THEN 'kept' ELSE 'updated' END AS "_action"
           FROM old o LEFT JOIN district_clean s ON s.DistrictID = o.DistrictID AND o.DistrictID <> -1""")
def update_matched_names(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return update_matched(
        _earlier_districts(bank), bank.district_clean, "DistrictID",
        ["DistrictName", "RegionName"], protect=F.col("DistrictID") == K.UNKNOWN_ID,
    )


# accounts loaded earlier: the monthly ones; every weekly one was closed, so
# its only row is not current
EARLIER_ACCOUNT = """
    SELECT CAST(0 AS BIGINT) AS AccountKey, CAST(-1 AS BIGINT) AS AccountID, 19000101 AS AccountOpenDate,
           'Unknown' AS StatementFrequency, 'Unknown' AS AccountAgeGroup, 'Unknown' AS SourceSystem,
           DATE '1900-01-01' AS EffectiveFrom, DATE '9999-12-31' AS EffectiveTo, true AS IsCurrent
    UNION ALL
    SELECT row_number() OVER (ORDER BY AccountID), AccountID, AccountOpenDateKey, 'Old', AccountAgeGroup,
           'Old', DATE '1990-01-01',
           CASE WHEN StatementFrequency = 'Weekly' THEN DATE '1998-12-31' ELSE DATE '9999-12-31' END,
           StatementFrequency <> 'Weekly'
    FROM account_clean WHERE StatementFrequency IN ('Monthly', 'Weekly')"""


def _earlier_accounts(bank: Bank):
    weekly = F.col("StatementFrequency") == "Weekly"
    old = bank.account_clean.filter(F.col("StatementFrequency").isin("Monthly", "Weekly")).select(
        "AccountID",
        F.col("AccountOpenDateKey").alias("AccountOpenDate"),
        F.lit("Old").alias("StatementFrequency"),
        "AccountAgeGroup",
        F.lit("Old").alias("SourceSystem"),
        F.lit("1990-01-01").cast("date").alias("EffectiveFrom"),
        F.when(weekly, F.lit("1998-12-31").cast("date"))
        .otherwise(F.lit(K.OPEN_END))
        .alias("EffectiveTo"),
        (~weekly).alias("IsCurrent"),
    )
    empty = dims.empty_dim(bank.spark, S.DIM_ACCOUNT, "AccountKey")
    return stage_table(insert_new(empty, old, "AccountID", "AccountKey").drop(ACTION))


@query(f"""WITH old AS ({EARLIER_ACCOUNT}),
           cur AS (SELECT * FROM old WHERE IsCurrent)
           SELECT c.AccountKey, c.AccountID, s.AccountOpenDateKey AS AccountOpenDate, s.StatementFrequency,
                  s.AccountAgeGroup, s.SourceSystem, c.EffectiveFrom, c.EffectiveTo, c.IsCurrent,
                  'updated' AS "_action"
           FROM cur c JOIN account_clean s USING (AccountID)
           UNION ALL SELECT *, 'kept' FROM old
               WHERE NOT IsCurrent OR AccountID NOT IN (SELECT AccountID FROM account_clean)
           UNION ALL
           SELECT (SELECT max(AccountKey) FROM old) + row_number() OVER (ORDER BY AccountID), AccountID,
                  AccountOpenDateKey, StatementFrequency, AccountAgeGroup, SourceSystem, AccountOpenDate,
                  DATE '9999-12-31', true, 'inserted'
           FROM account_clean WHERE AccountID NOT IN (SELECT AccountID FROM cur)""", name="upsert_current")
def upsert_current_accounts(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return dims.load_account(_earlier_accounts(bank), bank.account_clean)


@query("SELECT * FROM dim_account")
def dim_account(spark, sf_dir):
    return Bank(spark, sf_dir).dim_account


@query("SELECT * FROM dim_client")
def dim_client(spark, sf_dir):
    return Bank(spark, sf_dir).dim_client


@query("""SELECT 0 AS DistrictKey, -1 AS DistrictID, 'Unknown' AS DistrictName, 'Unknown' AS RegionName,
                 NULL AS Population, NULL AS AverageSalary, CAST(NULL AS DECIMAL(5,2)) AS UnemploymentMeasure,
                 NULL AS EntrepreneurMeasure, NULL AS CrimeMeasure
          UNION ALL
          SELECT CAST(row_number() OVER (ORDER BY CAST(district_id AS INTEGER)) AS INTEGER),
                 CAST(district_id AS INTEGER), coalesce(nullif(trim(district_name), ''), 'Unknown'),
                 coalesce(nullif(trim(region_name), ''), 'Unknown'), TRY_CAST(population AS INTEGER),
                 CAST(round(CAST(average_salary AS DECIMAL(18,2)), 0) AS INTEGER),
                 coalesce(TRY_CAST(unemployment_rate_1996 AS DECIMAL(5,2)),
                          TRY_CAST(unemployment_rate_1995 AS DECIMAL(5,2))),
                 CAST(entrepreneurs_per_1000_residents AS INTEGER),
                 coalesce(TRY_CAST(crimes_committed_1996 AS INTEGER),
                          TRY_CAST(nullif(trim(crimes_committed_1995), '') AS INTEGER))
          FROM district_text WHERE TRY_CAST(district_id AS INTEGER) IS NOT NULL""")
def dim_district(spark, sf_dir):
    empty = dims.empty_dim(spark, S.DIM_DISTRICT, "DistrictKey")
    return dims.dim_district(empty, role(spark, sf_dir, "district_text"))


STATISTICS = """SELECT count(*) AS TotalDimDistrictRows,
                 count(DISTINCT DistrictID) FILTER (DistrictID <> -1) AS DistinctSourceDistricts,
                 min(Population) FILTER (DistrictID <> -1) AS MinimumPopulation,
                 max(Population) FILTER (DistrictID <> -1) AS MaximumPopulation,
                 CAST(((2 * CAST(sum(AverageSalary) AS HUGEINT) * 100 + count(AverageSalary))
                       // (2 * count(AverageSalary))) * 0.01 AS DECIMAL(18,2)) AS OverallAverageSalary,
                 count(*) FILTER (DistrictID <> -1 AND Population IS NULL) AS MissingPopulation,
                 count(*) FILTER (DistrictID <> -1 AND AverageSalary IS NULL) AS MissingAverageSalary,
                 count(*) FILTER (DistrictID <> -1 AND UnemploymentMeasure IS NULL) AS MissingUnemployment,
                 count(*) FILTER (DistrictID <> -1 AND EntrepreneurMeasure IS NULL)
                     AS MissingEntrepreneurMeasure,
                 count(*) FILTER (DistrictID <> -1 AND CrimeMeasure IS NULL) AS MissingCrimeMeasure
          FROM dim_district"""


@query(STATISTICS, name="dimension_stats")
def district_statistics(spark, sf_dir):
    return validation.district_statistics(Bank(spark, sf_dir).dim_district)


# --- lookups -------------------------------------------------------------------


@query("""SELECT v.*, coalesce(n.n, 0) AS Loans FROM status_values v
          LEFT JOIN (SELECT LoanStatusCode, count(*) AS n FROM loan_clean GROUP BY 1) n USING (LoanStatusCode)""")
def constant_lookup(spark, sf_dir):
    """The status lookup from its constants, with the loans that use each member."""
    bank = Bank(spark, sf_dir)
    used = bank.loan_clean.groupBy("LoanStatusCode").agg(F.count("*").alias("Loans"))
    return bank.dim_loan_status.join(used, "LoanStatusCode", "left").fillna(0, ["Loans"])


@query("""SELECT v.*, coalesce(n.n, 0) AS Transactions FROM type_values v
          LEFT JOIN (SELECT TransactionTypeCode, count(*) AS n FROM transaction_clean GROUP BY 1) n
          USING (TransactionTypeCode)""")
def transaction_type_lookup(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    used = bank.transaction_clean.groupBy("TransactionTypeCode").agg(
        F.count("*").alias("Transactions")
    )
    return bank.dim_transaction_type.join(used, "TransactionTypeCode", "left").fillna(
        0, ["Transactions"]
    )


@query("""SELECT v.*, coalesce(n.n, 0) AS Transactions FROM operation_values v
          LEFT JOIN (SELECT OperationCode, count(*) AS n FROM transaction_clean GROUP BY 1) n
          USING (OperationCode)""")
def operation_lookup(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    used = bank.transaction_clean.groupBy("OperationCode").agg(F.count("*").alias("Transactions"))
    return bank.dim_operation.join(used, "OperationCode", "left").fillna(0, ["Transactions"])


@query("""SELECT CASE LoanStatusCode WHEN 'UNKNOWN' THEN 0 WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3
                     WHEN 'D' THEN 4 ELSE 5 END AS StatusRank, LoanStatusCode, count(*) AS Loans
          FROM (SELECT coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') AS LoanStatusCode FROM loan)
          GROUP BY ALL ORDER BY 1""")
def status_order(spark, sf_dir):
    counts = (
        role(spark, sf_dir, "loan")
        .groupBy(norm_code("status").alias("LoanStatusCode"))
        .agg(F.count("*").alias("Loans"))
    )
    return counts.withColumn("StatusRank", dims.status_rank("LoanStatusCode")).orderBy(
        "StatusRank", "LoanStatusCode"
    )


STATUS_FROM_CODES = f"""
    SELECT 0 AS LoanStatusKey, 'UNKNOWN' AS LoanStatusCode, 'Unknown Loan Status' AS LoanStatusDescription,
           'Unknown' AS LoanStatusGroup, false AS ProblemFlag
    UNION ALL
    SELECT CAST(row_number() OVER (ORDER BY c) AS INTEGER), c,
           coalesce(v.LoanStatusDescription, 'Other Loan Status'), coalesce(v.LoanStatusGroup, 'Unknown'),
           coalesce(v.ProblemFlag, false)
    FROM (SELECT DISTINCT {norm('status')} AS c FROM loan) LEFT JOIN status_values v ON v.LoanStatusCode = c
    WHERE c <> 'UNKNOWN'"""


def _status_dim(spark, sf_dir):
    empty = dims.empty_dim(spark, S.DIM_LOAN_STATUS, "LoanStatusKey")
    return dims.dim_from_codes(
        empty, role(spark, sf_dir, "loan"), "status", "LoanStatusCode", "LoanStatusKey",
        dims.describe_loan_status,
    )


@query(STATUS_FROM_CODES, name="lookup_from_codes")
def loan_status_from_codes(spark, sf_dir):
    return _status_dim(spark, sf_dir)


@query(f"""SELECT 0 AS TransactionTypeKey, 'UNKNOWN' AS TransactionTypeCode,
                  'Unknown Transaction Type' AS TransactionTypeName, 'Unknown' AS CashFlowDirection
           UNION ALL
           SELECT CAST(row_number() OVER (ORDER BY c) AS INTEGER), c,
                  coalesce(v.TransactionTypeName, 'Other Transaction Type'),
                  coalesce(v.CashFlowDirection, 'Unknown')
           FROM (SELECT DISTINCT {norm('type')} AS c FROM trans)
           LEFT JOIN type_values v ON v.TransactionTypeCode = c WHERE c <> 'UNKNOWN'""")
def transaction_type_from_codes(spark, sf_dir):
    empty = dims.empty_dim(spark, S.DIM_TRANSACTION_TYPE, "TransactionTypeKey")
    return dims.dim_from_codes(
        empty, role(spark, sf_dir, "trans"), "type", "TransactionTypeCode",
        "TransactionTypeKey", dims.describe_transaction_type,
    )


@query(f"""SELECT 0 AS OperationKey, 'UNKNOWN' AS OperationCode, 'Unknown Operation' AS OperationDescription,
                  'Unknown' AS OperationGroup
           UNION ALL
           SELECT CAST(row_number() OVER (ORDER BY c) AS INTEGER), c,
                  CASE WHEN c = 'CASH DEPOSIT' THEN 'Cash Deposit'
                       ELSE coalesce(v.OperationDescription, 'Other Operation') END,
                  CASE WHEN c = 'CASH DEPOSIT' THEN 'Cash Transaction'
                       ELSE coalesce(v.OperationGroup, 'Unknown') END
           FROM (SELECT DISTINCT {norm('operation')} AS c FROM trans)
           LEFT JOIN operation_values v ON v.OperationCode = c WHERE c <> 'UNKNOWN'""")
def operation_from_codes(spark, sf_dir):
    empty = dims.empty_dim(spark, S.DIM_OPERATION, "OperationKey")
    return dims.dim_from_codes(
        empty, role(spark, sf_dir, "trans"), "operation", "OperationCode", "OperationKey",
        dims.describe_operation,
    )


@query(f"""SELECT {norm('l.status')} AS SourceLoanStatus, coalesce(v.LoanStatusKey, 0) AS LoanStatusKey,
                  coalesce(v.LoanStatusDescription, 'Unknown Loan Status') AS LoanStatusDescription,
                  coalesce(v.LoanStatusGroup, 'Unknown') AS LoanStatusGroup,
                  coalesce(v.ProblemFlag, false) AS ProblemFlag, count(*) AS LoanCount,
                  {sum2('l.amount')} AS TotalLoanAmount
           FROM loan l LEFT JOIN status_values v ON v.LoanStatusCode = {norm('l.status')} GROUP BY ALL""", name="mapping_coverage")
def loan_status_coverage(spark, sf_dir):
    return validation.mapping_coverage(
        role(spark, sf_dir, "loan"), "status", Bank(spark, sf_dir).dim_loan_status,
        "LoanStatusCode", "LoanStatusKey",
        {"LoanStatusDescription": "Unknown Loan Status", "LoanStatusGroup": "Unknown",
         "ProblemFlag": False},
        "LoanCount", "SourceLoanStatus", "amount", "TotalLoanAmount",
    )


@query(f"""SELECT {norm('t.operation')} AS SourceOperation, coalesce(v.OperationKey, 0) AS OperationKey,
                  coalesce(v.OperationDescription, 'Unknown Operation') AS OperationDescription,
                  coalesce(v.OperationGroup, 'Unknown') AS OperationGroup, count(*) AS TransactionCount
           FROM trans t LEFT JOIN operation_values v ON v.OperationCode = {norm('t.operation')} GROUP BY ALL""")
def operation_coverage(spark, sf_dir):
    return validation.mapping_coverage(
        role(spark, sf_dir, "trans"), "operation", Bank(spark, sf_dir).dim_operation,
        "OperationCode", "OperationKey",
        {"OperationDescription": "Unknown Operation", "OperationGroup": "Unknown"},
        "TransactionCount", "SourceOperation",
    )


@query(f"""SELECT DISTINCT operation AS UnmappedOperation FROM trans
           WHERE {norm('operation')} NOT IN (SELECT OperationCode FROM operation_values)""", name="unmapped_values")
def unmapped_operations(spark, sf_dir):
    return validation.unmapped_values(
        role(spark, sf_dir, "trans"), "operation", Bank(spark, sf_dir).dim_operation,
        "OperationCode", "UnmappedOperation",
    )


@query(f"""SELECT DISTINCT status AS UnmappedLoanStatus FROM loan
           WHERE {norm('status')} NOT IN (SELECT LoanStatusCode FROM status_values)""")
def unmapped_loan_status(spark, sf_dir):
    return validation.unmapped_values(
        role(spark, sf_dir, "loan"), "status", Bank(spark, sf_dir).dim_loan_status,
        "LoanStatusCode", "UnmappedLoanStatus",
    )


@query(f"""SELECT {norm('t.type')} AS SourceType, coalesce(v.TransactionTypeKey, 0) AS TransactionTypeKey,
                  coalesce(v.TransactionTypeName, 'Unknown Transaction Type') AS TransactionTypeName,
                  coalesce(v.CashFlowDirection, 'Unknown') AS CashFlowDirection, count(*) AS TransactionCount,
                  {sum2('t.amount')} AS TotalAmount
           FROM trans t LEFT JOIN type_values v ON v.TransactionTypeCode = {norm('t.type')} GROUP BY ALL""")
def transaction_type_coverage(spark, sf_dir):
    return validation.mapping_coverage(
        role(spark, sf_dir, "trans"), "type", Bank(spark, sf_dir).dim_transaction_type,
        "TransactionTypeCode", "TransactionTypeKey",
        {"TransactionTypeName": "Unknown Transaction Type", "CashFlowDirection": "Unknown"},
        "TransactionCount", "SourceType", "amount",
    )


@query(f"""SELECT DISTINCT type AS UnmappedType FROM trans
           WHERE {norm('type')} NOT IN (SELECT TransactionTypeCode FROM type_values)""")
def unmapped_transaction_types(spark, sf_dir):
    return validation.unmapped_values(
        role(spark, sf_dir, "trans"), "type", Bank(spark, sf_dir).dim_transaction_type,
        "TransactionTypeCode", "UnmappedType",
    )
