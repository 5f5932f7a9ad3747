from ledgermill.functions.calendar import (
    as_of_column,
    days_between,
    fiscal_year_end,
    month_of,
    within_lookback,
)
from ledgermill.functions.money import exact_sum, guarded_ratio, money_sum, round_to
from ledgermill.functions.text import distinct_list

__all__ = [
    "as_of_column",
    "days_between",
    "distinct_list",
    "exact_sum",
    "fiscal_year_end",
    "guarded_ratio",
    "money_sum",
    "month_of",
    "round_to",
    "within_lookback",
]
