"""Column -> Column cleaners (no Python UDFs)."""

from spendloom.functions.exact import amount_digits, digits_total, exact_sum
from spendloom.functions.scalars import (amount_tokens, clean_amount, clean_date,
                                         clean_description, extract_deposit_amount,
                                         extract_withdrawal_amount, format_description,
                                         has_keyword, is_bank_transfer, iso_date_text,
                                         month_day, month_number, parse_sheet_date,
                                         py_strip, valid_iso_date)

__all__ = ["amount_digits", "amount_tokens", "clean_amount", "clean_date", "clean_description", "digits_total", "exact_sum",
           "extract_deposit_amount", "extract_withdrawal_amount", "format_description",
           "has_keyword", "is_bank_transfer", "iso_date_text", "month_day", "month_number",
           "parse_sheet_date", "py_strip", "valid_iso_date"]
