"""Call signs, flight numbers, codes and route texts."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column


def clean_code(c: Column | str) -> Column:
    return F.upper(F.trim(as_column(c)))


def has_prefix(c: Column | str, prefixes: Sequence[str]) -> Column:
    """True where the text starts with any of ``prefixes``; null stays null.

    One pattern, not one test per prefix: the text is often an expression, which every
    test would evaluate again.
    """
    return as_column(c).rlike("^(?:" + "|".join(map(re.escape, dict.fromkeys(prefixes))) + ")")


def first_of(*columns: Column | str) -> Column:
    return F.coalesce(*[as_column(c) for c in columns])


def route_text(origin: Column | str, destination: Column | str, sep: str = "->") -> Column:
    """``origin->destination``; null when either end is null."""
    return F.concat(as_column(origin), F.lit(sep), as_column(destination))


def flight_number(c: Column | str) -> Column:
    """First run of digits as an integer; null when there is none or it is too large."""
    return F.regexp_extract(as_column(c), r"(\d+)", 1).try_cast("int")


def all_digits(c: Column | str) -> Column:
    """All digits joined, as an integer (``AB12C3`` gives 123)."""
    return F.regexp_replace(as_column(c), r"\D", "").try_cast("int")


def trailing_digits(c: Column | str) -> Column:
    """Digits at the end, as text; empty when there are none."""
    return F.regexp_extract(as_column(c), r"(\d+)$", 1)


def make_callsign(prefix: Column | str, number: Column | str) -> Column:
    return F.concat(as_column(prefix), as_column(number))


def known_prefix(c: Column | str, prefixes: Sequence[str]) -> Column:
    """The first of ``prefixes`` that the text starts with, else null."""
    any_of = "|".join(re.escape(p) for p in prefixes)
    return F.nullif(F.regexp_extract(as_column(c), f"^({any_of})", 1), F.lit(""))


def airline_prefix(c: Column | str) -> Column:
    """Two or three leading capitals, else null."""
    return F.nullif(F.regexp_extract(as_column(c), r"^([A-Z]{2,3})", 1), F.lit(""))


def airline_iata(flight: Column | str) -> Column:
    """Two-character carrier code of a flight number such as ``6E102``, else null."""
    return F.nullif(
        F.regexp_extract(as_column(flight), r"^([A-Z0-9]{2})[0-9]+", 1), F.lit("")
    )
