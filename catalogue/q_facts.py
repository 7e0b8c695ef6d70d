"""Fact loads, batch and stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.bank import Bank
from catalogue.checks import big, sum2
from catalogue.registry import query
from catalogue.roles import table
from starloom.operators import control_totals, duplicate_keys, unmatched_rows
from starloom.plans import dims, facts, marts, validation
from starloom.session import new_path, rows_of, stage_table
from starloom.sources import SnapshotTable
from starloom.streaming import deliver, landing_stream


@query("SELECT * FROM loan_inner")
def fact_loan_inner(spark, sf_dir):
    """Unmatched loans dropped."""
    bank = Bank(spark, sf_dir)
    return facts.resolve_loans(bank.loan_clean, bank.loan_dims, "drop").rows


@query("SELECT * FROM fact_loan")
def fact_loan(spark, sf_dir):
    """Unmatched loans at key 0; first load."""
    return Bank(spark, sf_dir).fact_loan


@query("""WITH old AS (SELECT row_number() OVER (ORDER BY LoanID) AS LoanKey, * REPLACE (CAST(1 AS DECIMAL(18,2)) AS LoanAmount)
                       FROM loan_known WHERE LoanDateKey <= 19961231)
          SELECT o.LoanKey, s.*, 'updated' AS "_action" FROM old o JOIN loan_known s USING (LoanID)
          UNION ALL
          SELECT (SELECT max(LoanKey) FROM old) + row_number() OVER (ORDER BY LoanID), *, 'inserted'
          FROM loan_known WHERE LoanID NOT IN (SELECT LoanID FROM old)""")
def fact_loan_upsert(spark, sf_dir):
    """Loans up to 1996 were loaded with another amount; the load corrects them."""
    bank = Bank(spark, sf_dir)
    load = facts.resolve_loans(bank.loan_clean, bank.loan_dims, "unknown")
    earlier = facts.FactLoad(
        load.rows.filter(F.col("LoanDateKey") <= 19961231).withColumn(
            "LoanAmount", F.lit(1).cast("decimal(18,2)")
        ),
        load.unmatched,
    )
    target = stage_table(facts.upsert_loans(bank.no_loans, earlier).drop("_action"))
    return facts.upsert_loans(target, load)


@query("""SELECT row_number() OVER (ORDER BY l.loan_id) AS LoanKey, l.loan_id AS LoanID,
                 CAST(strftime(l.date, '%Y%m%d') AS INTEGER) AS LoanDateKey,
                 coalesce(a.AccountKey, 0) AS AccountKey, coalesce(d.DistrictKey, 0) AS DistrictKey,
                 coalesce(s.LoanStatusKey, 0) AS LoanStatusKey, 1 AS LoanCount, l.amount AS LoanAmount,
                 l.duration AS LoanDurationMonths, l.payments AS MonthlyPayment,
                 CAST(l.payments * l.duration AS DECIMAL(18,2)) AS ExpectedPaymentAmount,
                 CASE WHEN s.ProblemFlag THEN 1 ELSE 0 END AS ProblemLoanCount
          FROM loan l JOIN dim_date c ON c.FullDate = l.date
          LEFT JOIN dim_account a ON a.AccountID = l.account_id
          LEFT JOIN account sa ON sa.account_id = l.account_id
          LEFT JOIN dim_district d ON d.DistrictID = sa.district_id
          LEFT JOIN status_values s
               ON s.LoanStatusCode = coalesce(nullif(upper(trim(l.status)), ''), 'UNKNOWN')""")
def fact_loan_unknown(spark, sf_dir):
    """Full rebuild from the source loans."""
    bank = Bank(spark, sf_dir)
    return facts.rebuild_loans(
        stage_table(bank.stg("loan")), stage_table(bank.stg("account")), bank.loan_dims
    )


@query("""SELECT '_date' AS Lookup, 'drop' AS OnMissing,
                 count(*) FILTER (LoanDateKey NOT IN (SELECT DateKey FROM short_date)) AS UnmatchedRows FROM loan_clean
          UNION ALL SELECT 'AccountKey', 'unknown',
                 count(*) FILTER (AccountID NOT IN (SELECT AccountID FROM dim_account)) FROM loan_clean
          UNION ALL SELECT 'DistrictKey', 'unknown',
                 count(*) FILTER (DistrictID NOT IN (SELECT DistrictID FROM dim_district)) FROM loan_clean
          UNION ALL SELECT 'LoanStatusKey', 'unknown',
                 count(*) FILTER (LoanStatusCode NOT IN (SELECT LoanStatusCode FROM status_values)) FROM loan_clean""")
def fact_loan_unmatched(spark, sf_dir):
    """What a calendar that ends in 1998, given on purpose, would cut off."""
    bank = Bank(spark, sf_dir)
    short = {**bank.loan_dims, "DimDate": dims.dim_date(spark)}
    return unmatched_rows(
        bank.loan_clean, facts.loan_lookups(short, "unknown"), row_id="LoanID"
    )


@query("""WITH t AS (SELECT * FROM transaction_clean WHERE DateKey IN (SELECT DateKey FROM dim_date)
                     AND OperationCode IN (SELECT OperationCode FROM operation_values)
                     AND DistrictID IN (SELECT DistrictID FROM dim_district)),
               k AS (SELECT t.TransactionID, t.DateKey, a.AccountKey, d.DistrictKey, y.TransactionTypeKey,
                            o.OperationKey, t.TransactionCount, t.TransactionAmount, t.InflowAmount,
                            t.OutflowAmount, t.SignedAmount, t.BalanceAfterTransaction
                     FROM t JOIN dim_account a ON a.AccountID = t.AccountID
                     JOIN dim_district d ON d.DistrictID = t.DistrictID
                     JOIN type_values y ON y.TransactionTypeCode = t.TransactionTypeCode
                     JOIN operation_values o ON o.OperationCode = t.OperationCode),
               old AS (SELECT row_number() OVER (ORDER BY TransactionID) AS TransactionKey, * FROM k
                       WHERE DateKey <= 19961231)
          SELECT * FROM old
          UNION ALL
          SELECT (SELECT max(TransactionKey) FROM old) + row_number() OVER (ORDER BY TransactionID), *
          FROM k WHERE DateKey > 19961231""")
def fact_transaction_append(spark, sf_dir):
    """Transactions up to 1996 were loaded before; all are offered again."""
    bank = Bank(spark, sf_dir)
    earlier = facts.append_transactions(
        bank.no_transactions,
        rows_of(bank.transaction_clean, bank.transaction_clean.filter(F.col("DateKey") <= 19961231)),
        bank.transaction_dims, "drop",
    )
    target = stage_table(earlier.rows)
    fresh = facts.append_transactions(
        target, bank.transaction_clean, bank.transaction_dims, "drop"
    )
    return target.unionByName(fresh.rows)


@query("""WITH old AS (SELECT row_number() OVER (ORDER BY LoanID) AS LoanKey, * REPLACE (CAST(1 AS DECIMAL(18,2)) AS LoanAmount)
                       FROM loan_known WHERE LoanDateKey <= 19961231)
          SELECT o.LoanKey, s.* FROM old o JOIN loan_known s USING (LoanID)
          UNION ALL
          SELECT (SELECT max(LoanKey) FROM old) + row_number() OVER (ORDER BY LoanID), *
          FROM loan_known WHERE LoanID NOT IN (SELECT LoanID FROM old)""")
def fact_loan_merge(spark, sf_dir):
    """The published loan fact, loans up to 1996 with another amount, after a load that rewrites its changed buckets."""
    return _merged_loans(Bank(spark, sf_dir), F.lit(True)).read()


@query("""SELECT (SELECT count(*) FROM loan_known) AS UpdatedRows, CAST(0 AS BIGINT) AS InsertedRows, CAST(0 AS BIGINT) AS KeptRows,
                 (SELECT count(*) FROM loan_known) AS TableRows, CAST(1 AS BIGINT) AS RewrittenBuckets""")
def fact_loan_one_change(spark, sf_dir):
    """All loans are offered again and one of them differs: one bucket of the published fact is rewritten."""
    bank = Bank(spark, sf_dir)
    first = bank.loan_clean.agg(F.min("LoanID")).first()[0]
    table = _merged_loans(bank, F.col("LoanID") == first, later=False)
    before = table._latest().parts
    counts = facts.merge_loans(table, facts.resolve_loans(bank.loan_clean, bank.loan_dims, "unknown"))
    rewritten = [p for p in table._latest().parts if p not in before]
    return counts.select(
        "*", F.lit(table.rows()).cast("bigint").alias("TableRows"),
        F.lit(len({p.bucket for p in rewritten})).cast("bigint").alias("RewrittenBuckets"))


def _merged_loans(bank: Bank, changed, later: bool = True) -> SnapshotTable:
    """The loan fact in buckets of about 500 rows: published with another amount where ``changed``, then, if ``later``, loaded.

    With ``later`` only the loans up to 1996 are published first.
    """
    load = facts.resolve_loans(bank.loan_clean, bank.loan_dims, "unknown")
    rows = load.rows.filter(F.col("LoanDateKey") <= 19961231) if later else load.rows
    wrong = rows.withColumn("LoanAmount", F.when(changed, F.lit(1).cast("decimal(18,2)")).otherwise(F.col("LoanAmount")))
    table = facts.loan_table(bank.spark, new_path(bank.spark, "fact_loan"), bucket_rows=500)
    facts.merge_loans(table, facts.FactLoad(stage_table(wrong), load.unmatched))
    if later:
        facts.merge_loans(table, load)
    return table


@query("""WITH old AS (SELECT row_number() OVER (ORDER BY TransactionID) AS TransactionKey, * EXCLUDE (TransactionKey)
                       FROM fact_transaction WHERE DateKey <= 19961231),
               new AS (SELECT (SELECT max(TransactionKey) FROM old) + row_number() OVER (ORDER BY TransactionID) AS TransactionKey,
                              * EXCLUDE (TransactionKey) FROM fact_transaction WHERE DateKey > 19961231)
          SELECT *, CAST(DateKey // 10000 AS INTEGER) AS TransactionYear FROM (SELECT * FROM old UNION ALL SELECT * FROM new)""")
def fact_transaction_increments(spark, sf_dir):
    """The published fact after transactions up to 1996, then all of them, then all with a date of another year; none doubles."""
    bank = Bank(spark, sf_dir)
    table = facts.transaction_table(spark, new_path(spark, "fact_increments"))
    for offered in (
        bank.transaction_clean.filter(F.col("DateKey") <= 19961231),
        bank.transaction_clean,
        bank.transaction_clean.withColumn("DateKey", F.lit(19970101)),
    ):
        since = table.version()
        offered = rows_of(bank.transaction_clean, offered)
        table.append(facts.with_year(facts.append_transactions(table, offered, bank.transaction_dims).rows), since, spread=False)
    return table.read()


@query("SELECT * FROM fact_transaction")
def fact_transaction(spark, sf_dir):
    """First load, unmatched references at key 0."""
    return Bank(spark, sf_dir).fact_transaction


@query(f"""SELECT row_number() OVER (ORDER BY event_id) AS TransactionKey, event_id AS TransactionID,
                  CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS DateKey, coalesce(a.AccountKey, 0) AS AccountKey,
                  0 AS DistrictKey, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 3 ELSE 0 END
                      AS TransactionTypeKey,
                  0 AS OperationKey, 1 AS TransactionCount, v AS TransactionAmount,
                  CASE WHEN event_type = 'signup' THEN v ELSE 0 END AS InflowAmount,
                  CASE WHEN event_type = 'purchase' THEN v ELSE 0 END AS OutflowAmount,
                  CAST(CASE event_type WHEN 'signup' THEN v WHEN 'purchase' THEN -v ELSE 0 END
                      AS DECIMAL(18,2)) AS SignedAmount,
                  CAST(NULL AS DECIMAL(18,2)) AS BalanceAfterTransaction, 2024 AS TransactionYear
           FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events) e
           LEFT JOIN dim_account a ON a.AccountID = e.user_id""")
def fact_transaction_stream(spark, sf_dir):
    """Events delivered as transactions by a stream, each twice in a batch and then all again; none doubles."""
    from starloom.functions import date_key, inflow, money, outflow, signed

    bank = Bank(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    known = {**bank.transaction_dims, "DimDate": dims.stored_calendar(spark, *dims.calendar_range([(events, "ts")]))}
    code = F.when(F.col("event_type") == "signup", "PRIJEM").when(
        F.col("event_type") == "purchase", "VYDAJ"
    ).otherwise("UNKNOWN")

    def load(published, batch):
        transactions = batch.select(
            F.col("event_id").alias("TransactionID"),
            F.col("user_id").alias("AccountID"),
            F.lit(-1).alias("DistrictID"),
            date_key(F.col("ts").cast("date"), missing=None).alias("DateKey"),
            code.alias("TransactionTypeCode"),
            F.lit("UNKNOWN").alias("OperationCode"),
            F.lit(1).alias("TransactionCount"),
            money("value").alias("TransactionAmount"),
            inflow(code, money("value")).alias("InflowAmount"),
            outflow(code, money("value")).alias("OutflowAmount"),
            signed(code, money("value")).alias("SignedAmount"),
            F.lit(None).cast("decimal(18,2)").alias("BalanceAfterTransaction"),
        )
        twice = transactions.unionByName(transactions)
        return facts.with_year(facts.append_transactions(fact, twice, known, "unknown").rows)

    fact = facts.transaction_table(spark, new_path(spark, "fact_stream"))
    for delivery in ("first", "replay"):
        # a glob, so that the table may be one file or a folder of files
        stream = landing_stream(spark, f"{sf_dir}/events.parque[t]", events.schema)
        deliver(
            stream, fact, load, new_path(spark, delivery), facts.with_year(bank.no_transactions)
        ).awaitTermination()
    return fact.read()


@query(f"""SELECT count(*) AS TotalFactLoans, count(DISTINCT LoanID) AS DistinctLoanIDs,
                  {big('sum(LoanCount)')} AS TotalLoanCount, {big('sum(ProblemLoanCount)')} AS TotalProblemLoans,
                  {sum2('LoanAmount')} AS TotalLoanAmount,
                  {sum2('ExpectedPaymentAmount')} AS TotalExpectedPaymentAmount
           FROM fact_loan""")
def fact_totals(spark, sf_dir):
    return control_totals(
        Bank(spark, sf_dir).fact_loan,
        {"LoanCount": "TotalLoanCount", "ProblemLoanCount": "TotalProblemLoans",
         "LoanAmount": "TotalLoanAmount", "ExpectedPaymentAmount": "TotalExpectedPaymentAmount"},
        "TotalFactLoans", distinct={"LoanID": "DistinctLoanIDs"},
    )


@query("""SELECT count(*) FILTER (AccountKey = 0) AS UnknownAccountRows,
                 count(*) FILTER (DistrictKey = 0) AS UnknownDistrictRows,
                 count(*) FILTER (LoanStatusKey = 0) AS UnknownLoanStatusRows FROM fact_loan""")
def unknown_keys(spark, sf_dir):
    return Bank(spark, sf_dir).fact_loan.agg(
        F.count_if(F.col("AccountKey") == 0).alias("UnknownAccountRows"),
        F.count_if(F.col("DistrictKey") == 0).alias("UnknownDistrictRows"),
        F.count_if(F.col("LoanStatusKey") == 0).alias("UnknownLoanStatusRows"),
    )


@query(f"""SELECT s.LoanStatusCode, s.LoanStatusDescription, s.LoanStatusGroup, s.ProblemFlag,
                  {big('sum(f.LoanCount)')} AS LoanCount, {sum2('f.LoanAmount')} AS TotalLoanAmount,
                  CAST(((2 * CAST(sum(f.LoanAmount) * 100 AS HUGEINT) + count(*)) // (2 * count(*))) * 0.01
                      AS DECIMAL(18,2)) AS AverageLoanAmount,
                  {sum2('f.ExpectedPaymentAmount')} AS TotalExpectedPaymentAmount,
                  {big('sum(f.ProblemLoanCount)')} AS ProblemLoanCount
           FROM fact_loan f JOIN status_values s ON s.LoanStatusKey = f.LoanStatusKey GROUP BY ALL""")
def loans_by_status(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return marts.loans_by_status(bank.fact_loan, bank.dim_loan_status)


@query(f"""SELECT y.TransactionTypeName, y.CashFlowDirection, count(*) AS TransactionRecords,
                  {sum2('f.InflowAmount')} AS TotalInflow, {sum2('f.OutflowAmount')} AS TotalOutflow,
                  {sum2('f.SignedAmount')} AS NetAmount
           FROM fact_transaction f JOIN type_values y ON y.TransactionTypeKey = f.TransactionTypeKey
           GROUP BY ALL""")
def transactions_by_type(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return marts.transactions_by_type(bank.fact_transaction, bank.dim_transaction_type)


@query("""SELECT f.LoanKey, f.LoanID, f.LoanDateKey, c.FullDate AS LoanDate, f.AccountKey, a.AccountID,
                 f.DistrictKey, d.DistrictID, d.DistrictName, d.RegionName, f.LoanStatusKey, s.LoanStatusCode,
                 s.LoanStatusDescription, s.LoanStatusGroup, s.ProblemFlag, f.LoanCount, f.LoanAmount,
                 f.LoanDurationMonths, f.MonthlyPayment, f.ExpectedPaymentAmount, f.ProblemLoanCount
          FROM fact_loan f JOIN dim_date c ON c.DateKey = f.LoanDateKey
          LEFT JOIN dim_account a ON a.AccountKey = f.AccountKey
          LEFT JOIN dim_district d ON d.DistrictKey = f.DistrictKey
          LEFT JOIN status_values s ON s.LoanStatusKey = f.LoanStatusKey
          ORDER BY c.FullDate, f.LoanID LIMIT 100""")
def loan_listing(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return marts.loan_listing(bank.fact_loan, bank.loan_dims)


@query(f"""SELECT count(*) AS TotalFactTransactions, count(DISTINCT TransactionID) AS DistinctTransactionIDs,
                  {big('sum(TransactionCount)')} AS TotalTransactionCount,
                  {sum2('TransactionAmount')} AS TotalTransactionAmount, {sum2('InflowAmount')} AS TotalInflow,
                  {sum2('OutflowAmount')} AS TotalOutflow, {sum2('SignedAmount')} AS NetAmount
           FROM fact_transaction""")
def transaction_totals(spark, sf_dir):
    return control_totals(
        Bank(spark, sf_dir).fact_transaction,
        {"TransactionCount": "TotalTransactionCount", "TransactionAmount": "TotalTransactionAmount",
         "InflowAmount": "TotalInflow", "OutflowAmount": "TotalOutflow", "SignedAmount": "NetAmount"},
        "TotalFactTransactions", distinct={"TransactionID": "DistinctTransactionIDs"},
    )


@query("""SELECT (SELECT count(*) FROM transaction_clean WHERE BalanceAfterTransaction IS NULL) AS MissingInSource,
                 (SELECT count(*) FROM fact_transaction WHERE BalanceAfterTransaction IS NULL) AS MissingInFact""")
def missing_balances_kept(spark, sf_dir):
    """A missing balance stays missing: it does not become 0."""
    bank = Bank(spark, sf_dir)
    return validation.missing_balances(bank.transaction_clean, bank.fact_transaction)


@query("""SELECT LoanID, count(*) AS DuplicateCount FROM fact_loan GROUP BY LoanID HAVING count(*) > 1
          UNION ALL SELECT -1, count(*) FROM fact_loan""")
def duplicate_fact_loans(spark, sf_dir):
    """Loan ids that occur more than once in the fact, and all its rows as id -1."""
    fact = Bank(spark, sf_dir).fact_loan
    return duplicate_keys(fact, "LoanID").select("LoanID", "DuplicateCount").unionByName(
        fact.agg(F.lit(-1).cast("bigint").alias("LoanID"), F.count("*").alias("DuplicateCount"))
    )
