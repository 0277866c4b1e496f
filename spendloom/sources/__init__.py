"""Readers and writers."""

from spendloom.sources.contract import check_contract, split_contract
from spendloom.sources.readers import (captioned_csv, consolidate, inferred, numbered_lines, read_raw_tables, read_sheet,
                                       read_statement_csv, read_statement_periods, read_statement_text,
                                       statement_lines, statement_meta)
from spendloom.sources.sinks import ledger_csv_frame, preview, recover_ledger, write_ledger

__all__ = ["captioned_csv", "consolidate", "inferred", "numbered_lines", "read_raw_tables", "read_sheet", "read_statement_csv",
           "read_statement_periods", "read_statement_text", "statement_lines", "statement_meta",
           "ledger_csv_frame", "preview", "recover_ledger", "write_ledger",
           "check_contract", "split_contract"]
