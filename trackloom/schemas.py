"""Fixed table layouts, as DDL text in the order the tables are stored."""

# One position report of the batch feed.
STATES = (
    "time bigint, icao24 string, lat double, lon double, velocity double, "
    "heading double, vertrate double, callsign string, onground boolean, "
    "alert boolean, spi boolean, squawk string, baroaltitude double, "
    "geoaltitude double, lastposupdate double, lastcontact double"
)

# Flight history, one row per flight.
HISTORY = (
    "callsign string, estdepartureairport string, airportofdeparture string, "
    "estarrivalairport string, airportofdestination string, model string, "
    "typecode string, firstseen bigint"
)

# One position report of the live feed (JSON payload of the topic).
LIVE_STATES = (
    "icao24 string, callsign string, origin_country string, time_position bigint, "
    "last_contact bigint, longitude double, latitude double, baro_altitude double, "
    "on_ground boolean, velocity double, true_track double, vertical_rate double, "
    "sensors string, geo_altitude double, squawk string, spi boolean, "
    "position_source int, ingestion_time string"
)

# Live reports after route enrichment and state tracking (speed layer).
SPEED_STATES = (
    "icao24 string, callsign string, origin_country string, time_position bigint, "
    "last_contact bigint, ingestion_time string, longitude double, latitude double, "
    "baro_altitude double, geo_altitude double, on_ground boolean, velocity double, "
    "true_track double, vertical_rate double, sensors string, squawk string, "
    "spi boolean, position_source int, airline_prefix string, flight_number int, "
    "airline_name string, airline_iata string, airline_icao string, "
    "origin_code string, origin_city string, origin_airport string, "
    "origin_lat double, origin_lon double, destination_code string, "
    "destination_city string, destination_airport string, destination_lat double, "
    "destination_lon double, first_seen string, last_seen string, position_count int"
)

# Batch and live reports in one layout.
UNIFIED_STATES = (
    "icao24 string, callsign string, data_source string, timestamp bigint, "
    "last_contact bigint, time_position bigint, latitude double, longitude double, "
    "baro_altitude double, geo_altitude double, on_ground boolean, velocity double, "
    "true_track double, vertical_rate double, squawk string, spi boolean, "
    "position_source int, origin_code string, origin_city string, "
    "destination_code string, destination_city string, route string, "
    "aircraft_model string, aircraft_type string, airline_name string, "
    "airline_icao string, origin_country string, year int, month int, day int, "
    "hour int, ingestion_time string, first_seen string, last_seen string, "
    "position_count int"
)

LEDGER = (
    "file_path string, layer string, processed_at timestamp, record_count bigint, "
    "file_size_bytes bigint"
)


def fields(ddl: str) -> list[tuple[str, str]]:
    """Names and types of a layout, in order; the layouts above hold simple types only."""
    return [tuple(field.split()) for field in ddl.split(", ")]


def names(ddl: str) -> list[str]:
    return [name for name, _ in fields(ddl)]
