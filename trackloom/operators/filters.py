"""Row filters and column preparation."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions import (
    clean_code,
    event_time,
    has_prefix,
    in_bbox,
    utc_date,
    utc_hour,
    with_date_parts,
)


def filter_region(
    df: DataFrame,
    box: Mapping[str, float] = ref.REGION_BOX,
    prefixes: Sequence[str] = ref.REGION_PREFIXES,
    lat: str = "lat",
    lon: str = "lon",
    callsign: str = "callsign",
    epoch: str = "time",
) -> DataFrame:
    """Rows inside the box or with one of the call-sign prefixes, plus year, month, day.

    A row without coordinates stays only if its call sign matches.
    """
    wanted = in_bbox(lat, lon, box) | has_prefix(clean_code(callsign), prefixes)
    return with_date_parts(df.filter(wanted), epoch)


def has_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "")


def valid_history(df: DataFrame) -> DataFrame:
    """Cleaned call sign and both airports, for rows that have all three.

    The estimated airport wins over the stated one.
    """
    return df.withColumns(
        {
            "callsign_clean": clean_code("callsign"),
            "dep_airport": F.coalesce("estdepartureairport", "airportofdeparture"),
            "arr_airport": F.coalesce("estarrivalairport", "airportofdestination"),
        }
    ).filter(
        has_text("callsign_clean")
        & F.col("dep_airport").isNotNull()
        & F.col("arr_airport").isNotNull()
    )


def with_both_ends(
    df: DataFrame, origin: str = "origin_code", destination: str = "destination_code"
) -> DataFrame:
    return df.filter(F.col(origin).isNotNull() & F.col(destination).isNotNull())


def without_self_loops(
    df: DataFrame, origin: str = "origin_code", destination: str = "destination_code"
) -> DataFrame:
    return with_both_ends(df, origin, destination).filter(F.col(origin) != F.col(destination))


def region_routes(
    mapping: DataFrame,
    letter: str = ref.REGION_AIRPORT_LETTER,
    origin: str = "departure_airport",
    destination: str = "arrival_airport",
) -> DataFrame:
    """Routes with at least one end in the region."""
    return mapping.filter(
        F.col(origin).startswith(letter) | F.col(destination).startswith(letter)
    )


def fill_unknown(df: DataFrame, prefix: str = "airline_prefix") -> DataFrame:
    """Texts shown for flights without carrier or route."""
    fixed = {
        "airline_name": "Unknown",
        "airline_iata": "--",
        "origin_code": "UNK",
        "origin_city": "Unknown",
        "destination_code": "UNK",
        "destination_city": "Unknown",
    }
    filled = {
        name: F.coalesce(name, F.lit(text)) for name, text in fixed.items() if name in df.columns
    }
    if "airline_icao" in df.columns and prefix in df.columns:
        filled["airline_icao"] = F.coalesce("airline_icao", prefix)
    return df.withColumns(filled)


def with_processing_metadata(df: DataFrame, source: str = "speed_layer") -> DataFrame:
    return df.withColumns({"processing_time": F.current_timestamp(), "source": F.lit(source)})


# columns of the telemetry table, in order
TELEMETRY_COLUMNS = (
    "icao24 callsign callsign_clean squawk time timestamp flight_date hour_of_day "
    "lastposupdate lastcontact lat lon baroaltitude geoaltitude velocity heading "
    "vertrate onground alert spi departure_airport arrival_airport route "
    "aircraft_model aircraft_type year month day"
).split()


def telemetry_projection(gold: DataFrame) -> DataFrame:
    """Every report with its derived keys, one fixed column order."""
    return gold.withColumns(
        {
            "timestamp": event_time("time"),
            "flight_date": utc_date("time"),
            "hour_of_day": utc_hour("time"),
            "callsign_clean": clean_code("callsign"),
        }
    ).select(*TELEMETRY_COLUMNS)
