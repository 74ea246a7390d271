"""Column expressions. All are Spark built-ins, so they stay in generated code."""

from .geo import (
    bearing_deg,
    grid_bin,
    grid_key,
    haversine_km,
    in_bbox,
    interpolate_position,
)
from .text import (
    airline_iata,
    airline_prefix,
    all_digits,
    clean_code,
    first_of,
    flight_number,
    has_prefix,
    known_prefix,
    make_callsign,
    route_text,
    trailing_digits,
)
from .time import (
    event_time,
    flight_id,
    lookback,
    utc_date,
    utc_hour,
    with_date_parts,
    with_flight_keys,
)

__all__ = [
    "airline_iata", "airline_prefix", "all_digits", "bearing_deg", "clean_code",
    "event_time", "first_of", "flight_id", "flight_number", "grid_bin", "grid_key",
    "has_prefix", "haversine_km", "in_bbox", "interpolate_position", "known_prefix",
    "lookback", "make_callsign", "route_text", "trailing_digits", "utc_date",
    "utc_hour", "with_date_parts", "with_flight_keys",
]
