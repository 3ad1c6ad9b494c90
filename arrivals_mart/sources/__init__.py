"""Sources: parquet and CSV readers, header normalisation, label dictionaries."""

from arrivals_mart.sources.files import read_csv, read_parquet, read_table, register, rename_headers
from arrivals_mart.sources.labels import country_lookup, label_dictionary, port_lookup

__all__ = [
    "country_lookup",
    "label_dictionary",
    "port_lookup",
    "read_csv",
    "read_parquet",
    "read_table",
    "register",
    "rename_headers",
]
