"""Fixed values of the data model.

These must equal the values the warehouse has always used, or results differ;
they are facts about the data, not tuning knobs.
"""

from __future__ import annotations

import datetime as dt

# --- unknown members and open ends (fixed values) ---
UNKNOWN_KEY = 0
UNKNOWN_ID = -1
UNKNOWN_CODE = "UNKNOWN"
UNKNOWN_TEXT = "Unknown"
UNKNOWN_DATE_KEY = 19000101
BEGINNING = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)

# --- default ranges (fixed values, every user of them takes a parameter) ---
CALENDAR_START = dt.date(1900, 1, 1)
#: the end of a calendar that is asked for without one; a load takes its own from the data
CALENDAR_END = dt.date(1998, 12, 31)
OBSERVATION_END = dt.date(1999, 12, 31)

# --- account statement frequency (fixed values) ---
STATEMENT_FREQUENCY = {
    "POPLATEK MESICNE": "Monthly",
    "POPLATEK TYDNE": "Weekly",
    "POPLATEK PO OBRATU": "After Transaction",
}

# --- client role (fixed values) ---
CLIENT_ROLE = {
    "OWNER": "Owner",
    "DISPONENT": "Authorized User",
}

# --- loan status: code, description, group, problem flag (fixed values) ---
LOAN_STATUS = [
    ("UNKNOWN", "Unknown Loan Status", "Unknown", 0),
    ("A", "Completed Without Repayment Problems", "Completed", 0),
    ("B", "Completed With Repayment Problems", "Completed", 1),
    ("C", "Active Without Current Repayment Problems", "Active", 0),
    ("D", "Active With Current Debt", "Active", 1),
]
OTHER_LOAN_STATUS = "Other Loan Status"

# --- transaction type: code, name, direction (fixed values) ---
TRANSACTION_TYPE = [
    ("UNKNOWN", "Unknown Transaction Type", "Unknown"),
    ("PRIJEM", "Credit", "Incoming"),
    ("VYBER", "Withdrawal", "Outgoing"),
    ("VYDAJ", "Debit", "Outgoing"),
]
# English spellings accepted when the dimension is derived from source codes:
# the last two have a direction but no name of their own.
TRANSACTION_TYPE_ENGLISH = [
    ("CREDIT", "Credit", "Incoming"),
    ("DEBIT", "Debit", "Outgoing"),
    ("WITHDRAWAL", "Withdrawal", "Outgoing"),
    ("INCOMING", "Other Transaction Type", "Incoming"),
    ("OUTGOING", "Other Transaction Type", "Outgoing"),
]
OTHER_TRANSACTION_TYPE = "Other Transaction Type"

# --- operation: code, description, group (fixed values) ---
OPERATION = [
    ("UNKNOWN", "Unknown Operation", "Unknown"),
    ("PREVOD NA UCET", "Outgoing Bank Transfer", "Bank Transfer"),
    ("PREVOD Z UCTU", "Incoming Bank Transfer", "Bank Transfer"),
    ("VKLAD", "Cash Deposit", "Cash Transaction"),
    ("VYBER", "Cash Withdrawal", "Cash Transaction"),
    ("VYBER KARTOU", "Credit Card Withdrawal", "Card Transaction"),
]
OPERATION_ENGLISH = [
    ("CREDIT CARD WITHDRAWAL", "Credit Card Withdrawal", "Card Transaction"),
    ("CASH DEPOSIT", "Cash Deposit", "Cash Transaction"),
    ("COLLECTION FROM ANOTHER BANK", "Incoming Bank Transfer", "Bank Transfer"),
    ("INCOMING BANK TRANSFER", "Incoming Bank Transfer", "Bank Transfer"),
    ("CASH WITHDRAWAL", "Cash Withdrawal", "Cash Transaction"),
    ("REMITTANCE TO ANOTHER BANK", "Outgoing Bank Transfer", "Bank Transfer"),
    ("OUTGOING BANK TRANSFER", "Outgoing Bank Transfer", "Bank Transfer"),
]
OTHER_OPERATION = "Other Operation"

# --- money direction by transaction type (fixed values) ---
INFLOW_TYPES = ["PRIJEM"]
OUTFLOW_TYPES = ["VYDAJ", "VYBER"]

# --- names of report rows and columns (fixed values) ---
#: staging profile: the columns counted as missing, and those also counted when blank
MISSING_IN_ACCOUNT = {
    "account_id": "MissingAccountID", "district_id": "MissingDistrictID", "date": "MissingOpenDate",
    "frequency": "MissingFrequency",
}
MISSING_IN_TRANSACTIONS = {
    "trans_id": "MissingTransactionIDs", "account_id": "MissingAccountIDs", "date": "MissingDates",
    "amount": "MissingAmounts", "balance": "MissingBalances",
    "type": "MissingTypes", "operation": "MissingOperations",
}
MISSING_IN_LOANS = {
    "loan_id": "MissingLoanID", "account_id": "MissingAccountID", "date": "MissingLoanDate",
    "amount": "MissingAmount", "duration": "MissingDuration", "status": "MissingStatus",
}
#: row counts before and after each stage: name, source table, target table
STAGE_CHECKS = [
    ("Account transformation", "account", "account_clean"),
    ("Client transformation", "client", "client_clean"),
    ("District transformation", "district", "district_clean"),
    ("Loan transformation", "loan", "loan_clean"),
    ("Transaction transformation", "trans", "transaction_clean"),
    ("Loan fact loading", "loan_clean", "FactLoan"),
    ("Transaction fact loading", "transaction_clean", "FactTransaction"),
]
#: reconciliation of facts with marts
TRANSACTION_MART = "Transaction data mart"
LOAN_MART = "Loan data mart"
PROBLEM_LOAN_MART = "Problem-loan data mart"
#: the marts' names in the sheet of their rows
MONTHLY_MART = "MonthlyTransactionPerformance"
DISTRICT_MART = "DistrictLoanPerformance"
