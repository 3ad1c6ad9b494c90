"""Code decoding (X1, X2) and hash keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrivals_mart.functions._cols import as_col

# Arrival mode codes and their labels.
TRANSPORT_MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}

# Visa category codes and their labels.
TRAVEL_PURPOSES = {1: "Business", 2: "Pleasure", 3: "Student"}


def decode(c, mapping: Mapping, default=None) -> Column:
    """Searched CASE over literal codes; unknown codes and nulls give ``default``.

    A numeric column compared with int codes works for doubles too (6.0 = 6).
    """
    src = as_col(c)
    expr = None
    for code, label in mapping.items():
        expr = F.when(src == F.lit(code), F.lit(label)) if expr is None else expr.when(src == F.lit(code), F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def hash_key(*cols) -> Column:
    """md5 over the text concatenation of the parts; null if any part is null."""
    return F.md5(F.concat(*[as_col(c).cast("string") for c in cols]))
