"""DataFrame -> DataFrame operators."""

from spendloom.operators.bind import bind
from spendloom.operators.normalise import (dated_rows, drop_empty_rows, infer_year, map_roles,
                                           normalise_statements, sort_ledger,
                                           to_ledger, transaction_predicates)
from spendloom.operators.ordered import (fill_forward as ordered_fill_forward,
                                         previous_value, rollover_count, running_sum)
from spendloom.operators.quality import extraction_stats, header_inventory, period_chain, reconcile, rows_in_several_periods
from spendloom.operators.rank import placed
from spendloom.operators.spend import (cumulative, cumulatives, fill_forward, money_sum,
                                       spend_by, spend_by_period)

__all__ = ["bind", "dated_rows", "drop_empty_rows", "infer_year", "map_roles", "normalise_statements", "sort_ledger",
           "to_ledger", "transaction_predicates", "ordered_fill_forward", "previous_value",
           "rollover_count", "running_sum", "extraction_stats", "header_inventory",
           "reconcile", "period_chain", "rows_in_several_periods", "placed", "cumulative", "cumulatives", "fill_forward", "money_sum", "spend_by",
           "spend_by_period"]
