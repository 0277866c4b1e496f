"""Schemas, canonical column names and the fixed values the cleaners use.

The lists under "FIXED VALUES" must keep these exact contents for results to
match the statement tool this library re-implements; they are stated plainly
and in their natural order. Branch-specific locality terms are not part of the
defaults: callers pass their own through ``extra_noise_terms``.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType)

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

#: Expenditure sheet (header row, explicit schema instead of inference).
SHEET_SCHEMA = StructType([
    StructField("Date", StringType()),
    StructField("Item", StringType()),
    StructField("Expenditure", DoubleType()),
    StructField("Cumulative - Monthly", DoubleType()),
    StructField("Cumulative - Yearly", DoubleType()),
    StructField("Comments", DoubleType()),
    StructField("Category", StringType()),
])

#: Extracted tables: one row per table row, positional headers and cells.
#: ``(statement_id, table_idx, row_idx)`` is unique and is the total order.
RAW_ROWS_SCHEMA = StructType([
    StructField("statement_id", StringType()),
    StructField("table_idx", IntegerType()),
    StructField("row_idx", LongType()),
    StructField("headers", ArrayType(StringType())),
    StructField("cells", ArrayType(StringType())),
])

#: Canonical ledger columns and their CSV header names, in output order.
LEDGER_COLUMNS = ["value_date", "description", "deposit", "withdrawal", "balance"]
LEDGER_HEADERS = ["Value Date", "Description", "Deposit", "Withdrawal", "Balance"]

LEDGER_SCHEMA = StructType([
    StructField("value_date", StringType()),
    StructField("description", StringType()),
    StructField("deposit", DoubleType()),
    StructField("withdrawal", DoubleType()),
    StructField("balance", DoubleType()),
])

#: Money is summed as this decimal and cast to double in the last projection,
#: so totals do not depend on the order rows reach the aggregate. Amounts it
#: cannot hold (beyond 24 digits before the point) become NULL.
MONEY_DECIMAL = "decimal(30,6)"

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

#: English month abbreviations, January first.
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                       "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

#: Header role -> substrings that identify it (matched against the stripped,
#: lower-cased header; the first column holding any of them wins).
ROLE_ALIASES = {
    "date_desc": ["date   value description", "date", "value date", "description"],
    "deposit": ["cheque deposit", "deposit", "credit", "deposits"],
    "withdrawal": ["withdrawal", "debit", "payment", "withdrawals"],
    "balance": ["balance", "closing balance", "available balance"],
}

#: Year the inferred dates of every statement start in.
DEFAULT_START_YEAR = 2024

#: Upper-case words that mark a row text as a withdrawal / deposit.
WITHDRAWAL_KEYWORDS = ["WITHDRAWAL", "DEBIT", "PAYMENT", "PURCHASE", "PAYTM",
                       "UPI", "NEFT", "RTGS"]
DEPOSIT_KEYWORDS = ["CREDIT", "DEPOSIT", "CHEQUE", "NEFT CREDIT", "RTGS CREDIT",
                    "SALARY", "REFUND"]

#: Amount token patterns, tried in this order (group 1 is the token).
AMOUNT_TOKEN_PATTERNS = [
    r"(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)",
    r"(\d+\.\d{2})",
    r"(\d+)",
]

#: Broad boilerplate terms: a row without amounts whose text holds one of
#: these (case-insensitive) is not a transaction.
BROAD_NOISE_TERMS = ["CURRENCY", "ACCOUNT", "BRANCH", "Date", "STATEMENT",
                     "NOMINEE", "ADDRESS", "IFSC", "MICR", "Phone",
                     "Brought Forward"]

#: Narrow boilerplate terms: a match rejects the row even when it has amounts.
NARROW_NOISE_TERMS = ["STATEMENT DATE", "CURRENCY", "ACCOUNT TYPE", "ACCOUNT NO",
                      "NOMINEE REGISTERED", "BRANCH ADDRESS", "IFSC", "MICR CODE",
                      "Phone No", "Balance Brought Forward"]

#: Date patterns of the date cleaner, tried in this order. Java's \s knows
#: fewer white-space characters than Python's, so the cleaners put their own
#: class in its place; nothing else changes.
DATE_PATTERNS = [
    r"(\d{2})[/-](\d{2})[/-](\d{4})",
    r"(\d{2})[/-](\d{2})[/-](\d{2})",
    r"([A-Za-z]{3})\s+(\d{1,2})(?:\s+(\d{4}))?",
    r"(\d{1,2})\s+([A-Za-z]{3})(?:\s+(\d{4}))?",
]

#: First "three letters, white space, one or two digits" token.
MONTH_DAY_PATTERN = r"([A-Za-z]{3})\s+(\d{1,2})"

#: RTGS or NEFT credit or debit wording (case-insensitive).
BANK_TRANSFER_PATTERN = r"(RTGS|NEFT)\s+(CRED|DEB)"

#: Description clean-up: each label starts a span that runs to the next
#: phone marker.
DESCRIPTION_LABELS = ["STATEMENT DATE", "CURRENCY", "ACCOUNT TYPE", "ACCOUNT NO",
                      "NOMINEE REGISTERED", "BRANCH ADDRESS", "IFSC", "MICR CODE"]
#: The caller's locality terms go after this label.
DESCRIPTION_TERMS_AFTER = "BRANCH ADDRESS"
#: Span terminator, the bare marker, and two literal captions, in this order.
PHONE_MARKER = r"Phone No\.: \d+"
DESCRIPTION_TRAILING_PATTERNS = [r"Phone No\.: \d+", r"Balance Brought Forward",
                                 r"Date   Value Description Date"]

#: Statement preamble keys kept by ``statement_meta`` (nothing personal).
STATEMENT_META_KEYS = {
    "start date": "period_start",
    "end date": "period_end",
}
#: Preamble key prefix whose line carries the opening balance and its date.
OPENING_BALANCE_PREFIX = "balance on"
