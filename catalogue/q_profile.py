"""Profiles of the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.bank import Bank
from catalogue.checks import big, norm, sum2
from catalogue.registry import query
from catalogue.roles import TABLES, role, table
from starloom.functions import inflow, is_blank, map_code, norm_code, outflow, signed, total
from starloom.operators import (
    control_totals,
    count_where,
    duplicate_keys,
    orphan_count,
    row_count_sheet,
    value_frequency,
)
from starloom.plans import validation


@query(" UNION ALL ".join(f"SELECT '{t}' AS TableName, count(*) AS NumberOfRows FROM {t}" for t in TABLES), name="row_count_sheet")
def row_count_sheet_all(spark, sf_dir):
    return row_count_sheet({t: table(spark, sf_dir, t) for t in TABLES})


@query("SELECT frequency, count(*) AS NumberOfAccounts FROM account GROUP BY frequency", name="value_frequency")
def frequency_values(spark, sf_dir):
    return value_frequency(role(spark, sf_dir, "account"), "frequency", "NumberOfAccounts")


@query("SELECT operation, count(*) AS RecordCount FROM trans GROUP BY operation")
def operation_values(spark, sf_dir):
    return value_frequency(role(spark, sf_dir, "trans"), "operation")


@query(f"""SELECT type, count(*) AS TransactionCount, {sum2('amount')} AS TotalAmount
           FROM trans GROUP BY type""")
def amount_by_type(spark, sf_dir):
    return control_totals(
        role(spark, sf_dir, "trans"), {"amount": "TotalAmount"}, "TransactionCount", ["type"]
    )


@query(f"""SELECT status AS SourceStatus, count(*) AS NumberOfLoans, {sum2('amount')} AS TotalLoanAmount
           FROM loan GROUP BY status""")
def amount_by_status(spark, sf_dir):
    loan = role(spark, sf_dir, "loan").withColumnRenamed("status", "SourceStatus")
    return control_totals(loan, {"amount": "TotalLoanAmount"}, "NumberOfLoans", ["SourceStatus"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS DuplicateCount FROM lineitem
          GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""", name="duplicate_keys")
def duplicate_line_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT 'account' AS TableName, account_id AS DuplicateID, count(*) AS DuplicateCount
          FROM account GROUP BY account_id HAVING count(*) > 1
          UNION ALL SELECT 'client', client_id, count(*) FROM client GROUP BY client_id HAVING count(*) > 1
          UNION ALL SELECT 'loan', loan_id, count(*) FROM loan GROUP BY loan_id HAVING count(*) > 1
          UNION ALL SELECT 'trans', trans_id, count(*) FROM trans GROUP BY trans_id HAVING count(*) > 1""")
def duplicate_identifiers(spark, sf_dir):
    ids = {"account": "account_id", "client": "client_id", "loan": "loan_id", "trans": "trans_id"}
    tables = {name: role(spark, sf_dir, name) for name in ids}
    return validation.duplicate_identifiers(tables, ids)


@query("""SELECT count(*) FILTER (account_id IS NULL) AS MissingAccountID,
                 count(*) FILTER (district_id IS NULL) AS MissingDistrictID,
                 count(*) FILTER (date IS NULL) AS MissingOpenDate,
                 count(*) FILTER (coalesce(trim(frequency), '') = '') AS MissingFrequency
          FROM account""")
def missing_in_account(spark, sf_dir):
    return validation.missing_in_account(role(spark, sf_dir, "account"))


@query("""SELECT count(*) AS TotalTransactions,
                 count(*) - count(trans_id) AS MissingTransactionIDs,
                 count(*) - count(account_id) AS MissingAccountIDs, count(*) - count(date) AS MissingDates,
                 count(*) - count(amount) AS MissingAmounts, count(*) - count(balance) AS MissingBalances,
                 count(*) - count(nullif(trim(type), '')) AS MissingTypes,
                 count(*) - count(nullif(trim(operation), '')) AS MissingOperations
          FROM trans""", name="missing_profile")
def missing_in_transactions(spark, sf_dir):
    return validation.missing_in_transactions(role(spark, sf_dir, "trans"))


@query("""SELECT count(*) - count(loan_id) AS MissingLoanID, count(*) - count(account_id) AS MissingAccountID,
                 count(*) - count(date) AS MissingLoanDate, count(*) - count(amount) AS MissingAmount,
                 count(*) - count(duration) AS MissingDuration,
                 count(*) - count(nullif(trim(status), '')) AS MissingStatus
          FROM loan""")
def missing_in_loans(spark, sf_dir):
    return validation.missing_in_loans(role(spark, sf_dir, "loan"))


@query("""SELECT count(*) AS InvalidLoanRecords FROM loan
          WHERE amount <= 0 OR duration <= 0 OR payments <= 0""")
def invalid_loans(spark, sf_dir):
    return validation.invalid_loans(role(spark, sf_dir, "loan"))


@query("SELECT count(*) AS NegativeAmounts FROM trans WHERE amount < 0")
def invalid_transactions(spark, sf_dir):
    return validation.invalid_transactions(role(spark, sf_dir, "trans"))


@query("""SELECT (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS NegativeBalances,
                 (SELECT count(*) FROM customer WHERE c_acctbal = 0) AS ZeroBalances,
                 (SELECT count(*) FROM customer WHERE c_acctbal BETWEEN 0 AND 1000
                     AND c_mktsegment IN ('BUILDING', 'MACHINERY')) AS SmallBalances""")
def invalid_numeric(spark, sf_dir):
    balance = F.col("c_acctbal")
    return count_where(
        table(spark, sf_dir, "customer"),
        {
            "NegativeBalances": balance < 0,
            "ZeroBalances": balance == 0,
            "SmallBalances": balance.between(0, 1000)
            & F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
        },
    )


@query(f"""SELECT account_id, {norm('frequency')} AS Code,
                  CASE {norm('frequency')} WHEN 'POPLATEK MESICNE' THEN 'Monthly'
                      WHEN 'POPLATEK TYDNE' THEN 'Weekly' ELSE 'Unknown' END AS Defaulted,
                  CASE {norm('frequency')} WHEN 'POPLATEK MESICNE' THEN 'Monthly'
                      WHEN 'POPLATEK TYDNE' THEN 'Weekly' ELSE {norm('frequency')} END AS PassedThrough,
                  coalesce(trim(frequency), '') = '' AS Blank
           FROM account""")
def code_standardise(spark, sf_dir):
    names = {"POPLATEK MESICNE": "Monthly", "POPLATEK TYDNE": "Weekly"}
    return role(spark, sf_dir, "account").select(
        "account_id",
        norm_code("frequency").alias("Code"),
        map_code("frequency", names, "Unknown").alias("Defaulted"),
        map_code("frequency", names, keep_others=True).alias("PassedThrough"),
        is_blank("frequency").alias("Blank"),
    )


@query(f"""SELECT {norm('type')} AS TypeCode, count(*) AS Transactions,
                  {sum2(f"CASE WHEN {norm('type')} = 'PRIJEM' THEN amount ELSE 0 END")} AS TotalInflow,
                  {sum2(f"CASE WHEN {norm('type')} IN ('VYDAJ', 'VYBER') THEN amount ELSE 0 END")} AS TotalOutflow,
                  {sum2(f"CASE WHEN {norm('type')} = 'PRIJEM' THEN amount WHEN {norm('type')} IN ('VYDAJ', 'VYBER') THEN -amount ELSE 0 END")} AS NetAmount
           FROM trans GROUP BY 1""")
def signed_measures(spark, sf_dir):
    return (
        role(spark, sf_dir, "trans")
        .select(
            norm_code("type").alias("TypeCode"),
            inflow("type", "amount").alias("i"),
            outflow("type", "amount").alias("o"),
            signed("type", "amount").alias("s"),
        )
        .groupBy("TypeCode")
        .agg(
            F.count("*").alias("Transactions"),
            total("i").alias("TotalInflow"),
            total("o").alias("TotalOutflow"),
            total("s").alias("NetAmount"),
        )
    )


@query("""SELECT count(*) AS InvalidAccountReferences FROM trans t
          WHERE NOT EXISTS (SELECT 1 FROM account a WHERE a.account_id = t.account_id)""", name="orphan_count")
def orphan_transactions(spark, sf_dir):
    return orphan_count(
        role(spark, sf_dir, "trans"), "account_id", role(spark, sf_dir, "account"), "account_id",
        "InvalidAccountReferences",
    )


@query("""SELECT count(*) AS ClientsWithoutDisposition FROM client c
          WHERE NOT EXISTS (SELECT 1 FROM disp d WHERE d.client_id = c.client_id)""")
def clients_without_disposition(spark, sf_dir):
    return orphan_count(
        role(spark, sf_dir, "client"), "client_id", role(spark, sf_dir, "disp"), "client_id",
        "ClientsWithoutDisposition",
    )


@query("""SELECT count(*) AS ClientsWithoutValidDistrict FROM client c
          WHERE NOT EXISTS (SELECT 1 FROM district_clean d WHERE d.DistrictID = c.district_id)""")
def clients_without_valid_district(spark, sf_dir):
    return orphan_count(
        role(spark, sf_dir, "client"), "district_id", Bank(spark, sf_dir).district_clean,
        "DistrictID", "ClientsWithoutValidDistrict",
    )


@query("""SELECT c.client_id, c.birth_number, c.district_id, d.disp_id, d.account_id, d.type AS ClientRole
          FROM client c LEFT JOIN disp d ON d.client_id = c.client_id
          ORDER BY c.client_id, d.disp_id NULLS FIRST LIMIT 20""", name="client_disposition")
def client_dispositions(spark, sf_dir):
    return validation.client_dispositions(
        role(spark, sf_dir, "client"), role(spark, sf_dir, "disp")
    )


@query(f"""SELECT count(*) AS TotalLoans, count(DISTINCT account_id) AS Borrowers,
                  {sum2('amount')} AS TotalAmount, {big('sum(duration)')} AS TotalMonths FROM loan""")
def loan_control_totals(spark, sf_dir):
    return control_totals(
        role(spark, sf_dir, "loan"), {"amount": "TotalAmount", "duration": "TotalMonths"},
        "TotalLoans", distinct={"account_id": "Borrowers"},
    )
