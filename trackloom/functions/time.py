"""Epoch seconds to dates and hours, always in UTC.

Dates and hours are computed from the number itself, so the session time zone
does not matter and no timestamp conversion runs per row.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._columns import as_column
from .text import clean_code

DAY, HOUR = 86_400, 3_600


def event_time(epoch: Column | str) -> Column:
    return F.timestamp_seconds(as_column(epoch))


def utc_date(epoch: Column | str) -> Column:
    return F.date_from_unix_date(F.floor(as_column(epoch) / DAY).cast("int"))


def utc_hour(epoch: Column | str) -> Column:
    return F.pmod(F.floor(as_column(epoch) / HOUR), F.lit(24)).cast("int")


def with_date_parts(
    df: DataFrame, epoch: str = "time", parts: Sequence[str] = ("year", "month", "day")
) -> DataFrame:
    date = utc_date(epoch)
    known = {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "hour": utc_hour(epoch),
    }
    return df.withColumns({p: known[p] for p in parts})


def with_flight_keys(df: DataFrame, epoch: str = "time", callsign: str = "callsign") -> DataFrame:
    return df.withColumns(
        {"flight_date": utc_date(epoch), "callsign_clean": clean_code(callsign)}
    )


def flight_id(date: Column | str, callsign: Column | str) -> Column:
    """``date_callsign``; a missing call sign leaves only the date."""
    return F.concat_ws("_", as_column(date), as_column(callsign))


def lookback(
    df: DataFrame, epoch: str = "time", days: int = 7, until: Column | int | None = None
) -> DataFrame:
    """Keep the last ``days`` days before ``until`` (default: the newest row).

    Without ``until`` the newest value is a scalar subquery, so nothing is
    collected by the caller. Pass ``until`` when it is known: the filter is then
    a constant that reaches the scan.
    """
    if until is None:
        since = df.agg((F.max(epoch) - days * DAY).alias("since")).scalar()
    else:
        since = (until if isinstance(until, Column) else F.lit(until)) - days * DAY
    return df.filter(F.col(epoch) >= since)
