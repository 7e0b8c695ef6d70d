"""Declared schemas: sources, warehouse tables.  Production reads never infer."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 2)
PERCENT = T.DecimalType(6, 2)
TOTAL = T.DecimalType(38, 2)
# zone-less, like the database type it replaces
STAMP = T.TimestampNTZType()


def _schema(spec: str, **named: T.DataType) -> T.StructType:
    kinds = {
        "int": T.IntegerType(), "long": T.LongType(), "text": T.StringType(),
        "date": T.DateType(), "bool": T.BooleanType(), "double": T.DoubleType(),
        "money": MONEY, "rate": RATE, "percent": PERCENT, "total": TOTAL, "stamp": STAMP,
        "salary": T.DecimalType(10, 2), **named,
    }
    fields = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


# --- sources ---
ACCOUNT = _schema("account_id int, district_id int, frequency text, date date")
CLIENT = _schema("client_id int, birth_number date, district_id int")
DISP = _schema("disp_id int, client_id int, account_id int, type text")
LOAN = _schema(
    "loan_id int, account_id int, date date, amount money, duration int, payments money, status text"
)
TRANS = _schema(
    "trans_id int, account_id int, date date, type text, operation text,"
    "amount money, balance money, k_symbol text"
)
CARD_JSON = _schema("card_id int, disp_id int, type text, issued text")
CARD = _schema("card_id int, disp_id int, card_type text, issued stamp")

# The raw district file: positional names, '?' for a missing figure.
DISTRICT_FILE = _schema(
    "A1 int, A2 text, A3 text, A4 int, A5 int, A6 int, A7 int, A8 int, A9 int, A10 double,"
    "A11 int, A12 rate, A13 rate, A14 int, A15 int, A16 int"
)
DISTRICT_NAMES = {
    "A1": "district_id",
    "A2": "district_name",
    "A3": "region_name",
    "A4": "population",
    "A11": "average_salary",
    "A12": "unemployment_rate_1995",
    "A13": "unemployment_rate_1996",
    "A14": "entrepreneurs_per_1000_residents",
    "A15": "crimes_committed_1995",
    "A16": "crimes_committed_1996",
}
DISTRICT = _schema(
    "district_id int, district_name text, region_name text, population int, average_salary salary,"
    "unemployment_rate_1995 rate, unemployment_rate_1996 rate,"
    "entrepreneurs_per_1000_residents int, crimes_committed_1995 int, crimes_committed_1996 int"
)

# --- dimensions and facts ---
DIM_DISTRICT = _schema(
    "DistrictKey int, DistrictID int, DistrictName text, RegionName text, Population int,"
    "AverageSalary int, UnemploymentMeasure rate, EntrepreneurMeasure int, CrimeMeasure int"
)
DIM_ACCOUNT = _schema(
    "AccountKey long, AccountID long, AccountOpenDate int, StatementFrequency text,"
    "AccountAgeGroup text, SourceSystem text, EffectiveFrom date, EffectiveTo date, IsCurrent bool"
)
DIM_CLIENT = _schema(
    "ClientKey long, ClientID long, DistrictKey int, ClientRole text,"
    "EffectiveFrom date, EffectiveTo date, IsCurrent bool"
)
DIM_LOAN_STATUS = _schema(
    "LoanStatusKey int, LoanStatusCode text, LoanStatusDescription text,"
    "LoanStatusGroup text, ProblemFlag bool"
)
DIM_TRANSACTION_TYPE = _schema(
    "TransactionTypeKey int, TransactionTypeCode text, TransactionTypeName text,"
    "CashFlowDirection text"
)
DIM_OPERATION = _schema(
    "OperationKey int, OperationCode text, OperationDescription text, OperationGroup text"
)
FACT_LOAN = _schema(
    "LoanKey long, LoanID long, LoanDateKey int, AccountKey long, DistrictKey int,"
    "LoanStatusKey int, LoanCount int, LoanAmount money, LoanDurationMonths int,"
    "MonthlyPayment money, ExpectedPaymentAmount money, ProblemLoanCount int"
)
FACT_TRANSACTION = _schema(
    "TransactionKey long, TransactionID long, DateKey int, AccountKey long, DistrictKey int,"
    "TransactionTypeKey int, OperationKey int, TransactionCount int, TransactionAmount money,"
    "InflowAmount money, OutflowAmount money, SignedAmount money, BalanceAfterTransaction money"
)
