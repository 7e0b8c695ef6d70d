"""Comparison SQL: common table expressions and small SQL fragments (DuckDB)."""

from __future__ import annotations

import re

from catalogue.roles import OBSERVED_TO, ROLES, SOURCE_SYSTEM, TABLES
from starloom import constants as K

STAMP = "TIMESTAMP '2024-01-01 00:00:00'"


def norm(x: str) -> str:
    return f"coalesce(nullif(upper(trim({x})), ''), 'UNKNOWN')"


def key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def sum2(x: str) -> str:
    return f"CAST(sum({x}) AS DECIMAL(38,2))"


def mean2(total: str, count: str, kind: str = "DECIMAL(18,2)") -> str:
    """Exact, halves away from zero: non-negative cents over a count."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return (
        f"CAST(((2 * {cents} + ({count})) // (2 * nullif({count}, 0))) * 0.01 AS {kind})"
    )


def signed_case(kind: str, up: str, down: str) -> str:
    return f"CASE WHEN {kind} = 'PRIJEM' THEN {up} WHEN {kind} IN ('VYDAJ', 'VYBER') THEN {down} ELSE 0 END"


def latest(name: str, ident: str, columns: list[str]) -> str:
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return (
        f"SELECT * FROM {name} WHERE {ident} IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY {ident} ORDER BY {ties}) = 1"
    )


def quoted(x: object) -> str:
    return str(x).lower() if isinstance(x, (bool, int)) else f"'{x}'"


def listed(rows: list[tuple]) -> str:
    """The codes of a value table but for the unknown one."""
    return ", ".join(quoted(code) for code, *_ in rows if code != K.UNKNOWN_CODE)


def case_map(x: str, mapping: dict[str, str], other: str) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in mapping.items())
    return f"CASE upper(trim({x})) {whens} ELSE '{other}' END"


def numbered(rows: list[tuple], names: str) -> str:
    """Constant rows with their position as the key, 0 for the unknown member."""
    values = ", ".join(f"({i}, {', '.join(map(quoted, r))})" for i, r in enumerate(rows))
    return f"SELECT * FROM (VALUES {values}) AS t({names})"


def age_band(start: str, end_year: int) -> str:
    years = f"{end_year} - year({start})"
    return (
        f"CASE WHEN {start} IS NULL THEN 'Unknown' WHEN {years} BETWEEN 1 AND 4 THEN '1-4 Years' "
        f"WHEN {years} BETWEEN 5 AND 9 THEN '5-9 Years' ELSE 'Other' END"
    )


FREQUENCY = case_map("frequency", K.STATEMENT_FREQUENCY, K.UNKNOWN_TEXT)

CTES = {name: text.format(**{t: t for t in [*TABLES, *ROLES]}) for name, text in ROLES.items()}
CTES |= {
    "account_clean": f"""
        SELECT account_id AS AccountID, coalesce(district_id, -1) AS DistrictID,
               {FREQUENCY} AS StatementFrequency, date AS AccountOpenDate,
               coalesce({key('date')}, 19000101) AS AccountOpenDateKey,
               CAST({OBSERVED_TO.year} - year(date) AS INTEGER) AS AccountAgeYears,
               {age_band('date', OBSERVED_TO.year)} AS AccountAgeGroup,
               '{SOURCE_SYSTEM}' AS SourceSystem, {STAMP} AS ETL_LoadDateTime
        FROM account""",
    "district_clean": f"""
        SELECT district_id AS DistrictID,
               coalesce(nullif(trim(district_name), ''), 'Unknown') AS DistrictName,
               coalesce(nullif(trim(region_name), ''), 'Unknown') AS RegionName,
               population AS Population,
               CAST(round(average_salary, 0) AS INTEGER) AS AverageSalary,
               CAST(coalesce(unemployment_rate_1996, unemployment_rate_1995) AS DECIMAL(5,2))
                   AS UnemploymentMeasure,
               entrepreneurs_per_1000_residents AS EntrepreneurMeasure,
               coalesce(crimes_committed_1996, crimes_committed_1995) AS CrimeMeasure,
               {STAMP} AS ETL_LoadDateTime
        FROM district""",
    "client_clean": f"""
        SELECT c.client_id AS ClientID,
               CASE WHEN c.district_id IN (SELECT DistrictID FROM district_clean)
                    THEN c.district_id ELSE -1 END AS DistrictID,
               {case_map('d.type', K.CLIENT_ROLE, K.UNKNOWN_TEXT)} AS ClientRole,
               d.disp_id AS DispositionID, d.account_id AS AccountID, c.birth_number AS BirthDate,
               CAST({OBSERVED_TO.year} - year(c.birth_number) AS INTEGER) AS AgeAtDatasetEnd,
               {STAMP} AS ETL_LoadDateTime
        FROM client c LEFT JOIN disp d ON d.client_id = c.client_id
        QUALIFY row_number() OVER (PARTITION BY c.client_id
            ORDER BY CASE WHEN upper(trim(d.type)) = 'OWNER' THEN 1 ELSE 2 END, d.disp_id) = 1""",
    "loan_clean": f"""
        SELECT l.loan_id AS LoanID, l.account_id AS AccountID,
               coalesce(a.DistrictID, -1) AS DistrictID, l.date AS LoanDate,
               coalesce({key('l.date')}, 19000101) AS LoanDateKey,
               v.LoanStatusCode, v.LoanStatusDescription, v.LoanStatusGroup,
               l.amount AS LoanAmount, l.duration AS LoanDurationMonths,
               l.payments AS MonthlyPayment,
               CAST(l.payments * l.duration AS DECIMAL(18,2)) AS ExpectedPaymentAmount,
               1 AS LoanCount, CAST(v.ProblemFlag AS INTEGER) AS ProblemLoanCount,
               {STAMP} AS ETL_LoadDateTime
        FROM loan l LEFT JOIN account_clean a ON a.AccountID = l.account_id
        JOIN status_values v ON v.LoanStatusCode =
             CASE WHEN {norm('l.status')} IN ({listed(K.LOAN_STATUS)}) THEN {norm('l.status')} ELSE 'UNKNOWN' END
        WHERE l.amount > 0 AND l.duration > 0 AND l.payments > 0""",
    "trans_one": latest(
        "trans", "trans_id",
        ["account_id", "date", "type", "operation", "amount", "balance", "k_symbol"],
    ),
    "transaction_clean": f"""
        SELECT t.trans_id AS TransactionID, t.account_id AS AccountID, a.DistrictID,
               t.date AS TransactionDate, {key('t.date')} AS DateKey,
               CASE WHEN {norm('t.type')} IN ({listed(K.TRANSACTION_TYPE)}) THEN {norm('t.type')}
                    ELSE 'UNKNOWN' END AS TransactionTypeCode,
               {norm('t.operation')} AS OperationCode, t.amount AS TransactionAmount,
               CAST({signed_case(norm('t.type'), 't.amount', '0')} AS DECIMAL(18,2)) AS InflowAmount,
               CAST({signed_case(norm('t.type'), '0', 't.amount')} AS DECIMAL(18,2)) AS OutflowAmount,
               CAST({signed_case(norm('t.type'), 't.amount', '-t.amount')} AS DECIMAL(18,2)) AS SignedAmount,
               t.balance AS BalanceAfterTransaction, {norm('t.k_symbol')} AS PurposeCode,
               1 AS TransactionCount, {STAMP} AS ETL_LoadDateTime
        FROM trans_one t JOIN account_clean a ON a.AccountID = t.account_id
        WHERE t.date IS NOT NULL AND t.amount IS NOT NULL""",
    # --- dimensions ---
    "status_values": numbered(
        [(c, d, g, bool(p)) for c, d, g, p in K.LOAN_STATUS],
        "LoanStatusKey, LoanStatusCode, LoanStatusDescription, LoanStatusGroup, ProblemFlag"),
    "type_values": numbered(
        K.TRANSACTION_TYPE, "TransactionTypeKey, TransactionTypeCode, TransactionTypeName, CashFlowDirection"),
    "operation_values": numbered(
        K.OPERATION, "OperationKey, OperationCode, OperationDescription, OperationGroup"),
    "dim_date": f"""
        SELECT {key('d')} AS DateKey, CAST(d AS DATE) AS FullDate, CAST(day(d) AS INTEGER) AS DayNumber,
               dayname(d) AS DayName, CAST(weekofyear(d) AS INTEGER) AS WeekNumber,
               CAST(month(d) AS INTEGER) AS MonthNumber, monthname(d) AS MonthName,
               CAST(quarter(d) AS INTEGER) AS Quarter, CAST(year(d) AS INTEGER) AS Year,
               strftime(d, '%m') AS YearMonth
        FROM (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM calendar_range)""",
    "calendar_range": """
        SELECT make_date(least(1900, min(y)), 1, 1) AS a, make_date(greatest(1900, max(y)), 12, 31) AS b
        FROM (SELECT year(date) AS y FROM loan UNION ALL SELECT year(date) FROM trans)""",
    "short_date": "SELECT * FROM dim_date WHERE FullDate <= DATE '1998-12-31'",
    "dim_district": """
        SELECT 0 AS DistrictKey, -1 AS DistrictID, 'Unknown' AS DistrictName, 'Unknown' AS RegionName,
               NULL AS Population, NULL AS AverageSalary, CAST(NULL AS DECIMAL(5,2)) AS UnemploymentMeasure,
               NULL AS EntrepreneurMeasure, NULL AS CrimeMeasure
        UNION ALL
        SELECT CAST(row_number() OVER (ORDER BY DistrictID) AS INTEGER), DistrictID, DistrictName,
               RegionName, Population, AverageSalary, UnemploymentMeasure, EntrepreneurMeasure, CrimeMeasure
        FROM district_clean""",
    "dim_account": """
        SELECT CAST(0 AS BIGINT) AS AccountKey, CAST(-1 AS BIGINT) AS AccountID,
               19000101 AS AccountOpenDate, 'Unknown' AS StatementFrequency,
               'Unknown' AS AccountAgeGroup, 'Unknown' AS SourceSystem, DATE '1900-01-01' AS EffectiveFrom,
               DATE '9999-12-31' AS EffectiveTo, true AS IsCurrent
        UNION ALL
        SELECT row_number() OVER (ORDER BY AccountID), AccountID, AccountOpenDateKey, StatementFrequency,
               AccountAgeGroup, SourceSystem, AccountOpenDate, DATE '9999-12-31', true
        FROM account_clean""",
    "dim_client": """
        SELECT row_number() OVER (ORDER BY c.ClientID) AS ClientKey, c.ClientID, d.DistrictKey, c.ClientRole,
               DATE '2024-01-01' AS EffectiveFrom, DATE '9999-12-31' AS EffectiveTo, true AS IsCurrent
        FROM client_clean c JOIN dim_district d ON d.DistrictID = c.DistrictID""",
    # --- facts: unmatched rows dropped, or pointed at key 0 ---
    "loan_inner": """
        SELECT l.LoanID, l.LoanDateKey, a.AccountKey, d.DistrictKey, s.LoanStatusKey, l.LoanCount,
               l.LoanAmount, l.LoanDurationMonths, l.MonthlyPayment, l.ExpectedPaymentAmount,
               l.ProblemLoanCount
        FROM loan_clean l JOIN dim_date c ON c.DateKey = l.LoanDateKey
        JOIN dim_account a ON a.AccountID = l.AccountID JOIN dim_district d ON d.DistrictID = l.DistrictID
        JOIN status_values s ON s.LoanStatusCode = l.LoanStatusCode""",
    "loan_known": """
        SELECT l.LoanID, l.LoanDateKey, coalesce(a.AccountKey, 0) AS AccountKey,
               coalesce(d.DistrictKey, 0) AS DistrictKey, s.LoanStatusKey, l.LoanCount, l.LoanAmount,
               l.LoanDurationMonths, l.MonthlyPayment, l.ExpectedPaymentAmount, l.ProblemLoanCount
        FROM loan_clean l JOIN dim_date c ON c.DateKey = l.LoanDateKey
        LEFT JOIN dim_account a ON a.AccountID = l.AccountID
        LEFT JOIN dim_district d ON d.DistrictID = l.DistrictID
        JOIN status_values s ON s.LoanStatusCode = l.LoanStatusCode""",
    "fact_loan": "SELECT row_number() OVER (ORDER BY LoanID) AS LoanKey, * FROM loan_known",
    "trans_known": """
        SELECT t.TransactionID, t.DateKey, coalesce(a.AccountKey, 0) AS AccountKey,
               coalesce(d.DistrictKey, 0) AS DistrictKey, y.TransactionTypeKey,
               coalesce(o.OperationKey, 0) AS OperationKey, t.TransactionCount, t.TransactionAmount,
               t.InflowAmount, t.OutflowAmount, t.SignedAmount, t.BalanceAfterTransaction
        FROM transaction_clean t JOIN dim_date c ON c.DateKey = t.DateKey
        LEFT JOIN dim_account a ON a.AccountID = t.AccountID
        LEFT JOIN dim_district d ON d.DistrictID = t.DistrictID
        JOIN type_values y ON y.TransactionTypeCode = t.TransactionTypeCode
        LEFT JOIN operation_values o ON o.OperationCode = t.OperationCode""",
    "fact_transaction": """
        SELECT row_number() OVER (ORDER BY TransactionID) AS TransactionKey, * FROM trans_known""",
    # --- marts over those facts ---
    "monthly": f"""
        SELECT c.Year, c.MonthNumber, c.MonthName, c.Quarter,
               printf('%d-%02d', c.Year, c.MonthNumber) AS YearMonthLabel,
               {big('sum(f.TransactionCount)')} AS TotalTransactions,
               count(DISTINCT f.AccountKey) AS ActiveAccounts,
               {sum2('f.TransactionAmount')} AS TotalTransactionAmount,
               {sum2('f.InflowAmount')} AS TotalInflow, {sum2('f.OutflowAmount')} AS TotalOutflow,
               {sum2('f.SignedAmount')} AS NetCashFlow,
               {mean2('sum(f.TransactionAmount)', 'sum(f.TransactionCount)')} AS AverageTransactionAmount
        FROM fact_transaction f JOIN dim_date c ON c.DateKey = f.DateKey
        GROUP BY ALL""",
    "district_mart": f"""
        SELECT d.DistrictKey, d.DistrictID, d.DistrictName, d.RegionName, d.Population, d.AverageSalary,
               d.UnemploymentMeasure, d.EntrepreneurMeasure, d.CrimeMeasure,
               {big('sum(f.LoanCount)')} AS TotalLoans, count(DISTINCT f.AccountKey) AS BorrowingAccounts,
               {sum2('f.LoanAmount')} AS TotalLoanAmount,
               {mean2('sum(f.LoanAmount)', 'sum(f.LoanCount)')} AS AverageLoanAmount,
               {sum2('f.MonthlyPayment')} AS TotalMonthlyPayments,
               {sum2('f.ExpectedPaymentAmount')} AS TotalExpectedPaymentAmount,
               {big('sum(f.ProblemLoanCount)')} AS ProblemLoans,
               {mean2('100 * sum(f.ProblemLoanCount)', 'sum(f.LoanCount)', 'DECIMAL(6,2)')}
                   AS ProblemLoanPercentage
        FROM fact_loan f JOIN dim_district d ON d.DistrictKey = f.DistrictKey
        WHERE d.DistrictID <> -1 GROUP BY ALL""",
}


def sql(body: str) -> str:
    """``body`` with the common table expressions it needs in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(definition) if definition is not text else None
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
