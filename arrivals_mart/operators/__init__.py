"""Relational operators: lookups, dense keys, windows, quality checks, sinks."""

from arrivals_mart.operators.keys import dense_key
from arrivals_mart.operators.lookups import lookup_join, row_count_at_most, sized_broadcast
from arrivals_mart.operators.quality import assert_checks, duplicate_keys, run_checks, table_checks
from arrivals_mart.operators.sinks import create_targets, overwrite, truncate_and_load, write_contract
from arrivals_mart.operators.windows import top_k, trailing_average

__all__ = [
    "assert_checks",
    "create_targets",
    "dense_key",
    "duplicate_keys",
    "lookup_join",
    "overwrite",
    "row_count_at_most",
    "run_checks",
    "sized_broadcast",
    "table_checks",
    "top_k",
    "trailing_average",
    "truncate_and_load",
    "write_contract",
]
