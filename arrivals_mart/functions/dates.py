"""Date and time conversions.

All helpers are built-in expressions. Timestamps are produced as
``timestamp_ntz`` holding UTC wall-clock time, so results do not depend on
the session time zone and render as ``yyyy-MM-dd HH:mm:ss`` text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrivals_mart.functions._cols import as_col
from arrivals_mart.functions.casts import tolerant_int

# Origin of SAS day numbers and of epoch milliseconds.
SAS_EPOCH = "1960-01-01"
UNIX_EPOCH_NTZ = "1970-01-01 00:00:00"


def _sas_epoch() -> Column:
    return F.lit(SAS_EPOCH).cast("date")


def _unix_epoch() -> Column:
    return F.lit(UNIX_EPOCH_NTZ).cast("timestamp_ntz")


def from_day_number(c) -> Column:
    """Days since 1960-01-01 (double, possibly null/junk) -> date. 20545.0 -> 2016-04-01."""
    return F.date_add(_sas_epoch(), tolerant_int(c))


def to_day_number(c) -> Column:
    """Date or timestamp -> days since 1960-01-01 as int."""
    return F.datediff(as_col(c).cast("date"), _sas_epoch())


def from_epoch_ms(c) -> Column:
    """Epoch milliseconds -> timestamp_ntz (UTC), whole seconds.

    The milliseconds are integer-divided by 1000 before conversion, so the
    sub-second part is dropped as in the source warehouse query.
    """
    ms = as_col(c).cast("bigint")
    # integer division truncating towards zero, like the warehouse's bigint '/'
    seconds = F.call_function("div", ms, F.lit(1000).cast("bigint"))
    return F.timestamp_add("SECOND", seconds, _unix_epoch())


def epoch_ms(c) -> Column:
    """timestamp_ntz (UTC wall clock) -> epoch milliseconds (bigint)."""
    return F.timestamp_diff("MILLISECOND", _unix_epoch(), as_col(c).cast("timestamp_ntz"))


def date_parts(c) -> dict[str, Column]:
    """The six parts of the time dimension; ``weekday`` counts 0 = Sunday, ``week`` is ISO."""
    ts = as_col(c)
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": F.dayofweek(ts) - 1,
    }


def month_start(c) -> Column:
    """First day of the month of a date/timestamp, as a date."""
    return F.trunc(as_col(c).cast("date"), "month")


def month_index(c) -> Column:
    """Calendar month number (year * 12 + month - 1) for RANGE window frames."""
    d = as_col(c)
    return F.year(d) * 12 + F.month(d) - 1
