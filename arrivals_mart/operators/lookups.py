"""Lookup joins.

Lookups (ports, countries, nations) are code lists whose size is set by the
domain, not by the fact data. They are broadcast only after an exact size
check; a lookup that turns out larger than the bound is joined the normal
way (shuffle join, which AQE may still turn into a broadcast at run time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_LOOKUP_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than max_rows + 1."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_MAX_LOOKUP_ROWS) -> DataFrame:
    """Broadcast hint on ``df`` only if it is proven to hold at most ``max_rows`` rows.

    ``max_rows=None`` is for tables whose size is fixed by definition (for
    example a code list with a fixed number of entries); they are broadcast
    without a counting job.
    """
    if max_rows is None:
        return F.broadcast(df)
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def _scatter(df: DataFrame) -> Column:
    """Text that equals no code, different from row to row: stands in for a null key."""
    return F.concat(F.lit("\u0000no-key:"), F.xxhash64(*_own_columns(df)).cast("string"))


def _own_columns(df: DataFrame) -> list[Column]:
    return [df[f"`{c}`"] for c in dict.fromkeys(df.columns) if df.columns.count(c) == 1]


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    left_keys: Sequence[Column],
    right_keys: Sequence[str],
    how: str = "left",
    case_insensitive: bool = False,
    max_rows: int | None = DEFAULT_MAX_LOOKUP_ROWS,
    alias: str | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """Join ``df`` to a code lookup on (transformed) keys.

    ``left_keys`` are expressions over ``df``; ``right_keys`` name lookup
    columns, transformed the same way when ``case_insensitive`` (lower case on
    both sides). ``alias`` names the lookup so it can be joined more than once
    (role-playing lookups); its columns are then reachable as ``alias.col``.
    ``broadcast`` forces the decision when it was already made (a lookup
    joined in two roles is counted once); by default the size is checked.
    """
    side = lookup.alias(alias) if alias else lookup
    if broadcast is None:
        broadcast = max_rows is None or row_count_at_most(lookup, max_rows)
    if broadcast:
        side = F.broadcast(side)
    prefix = f"{alias}." if alias else ""
    conds = []
    for lk, rk in zip(left_keys, right_keys):
        rc = F.col(f"{prefix}{rk}")
        if case_insensitive:
            lk, rc = F.lower(lk), F.lower(rc)
        if broadcast is False and how == "left":
            # a shuffle join: left rows without a key match nothing, so they need not meet in one task
            lk, rc = F.coalesce(lk.cast("string"), _scatter(df)), rc.cast("string")
        conds.append(lk == rc)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return df.join(side, cond, how)
