"""The star schema: flight facts, route, aircraft and airspace dimensions.

Wide aggregates are kept numeric, so that they are hash aggregates with a map-side
partial step, whatever the size of a group. A text measure or a distinct count in the
same aggregate would make Spark sort every input row several times; these are taken
apart into a narrow branch or a second level that sees few rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    flight_id,
    grid_bin,
    grid_key,
    route_text,
    utc_date,
    utc_hour,
    with_flight_keys,
)
from ..reference_data import SECONDS_PER_POINT
from . import tracks
from .filters import valid_history

FLIGHT_KEYS = [
    "flight_date", "callsign_clean", "icao24", "departure_airport", "arrival_airport", "route",
]
AIRCRAFT = ["aircraft_model", "aircraft_type"]


def flagged(flag: Column | str) -> Column:
    """Number of rows where the flag is true; a missing flag counts as false."""
    return F.count(F.when(F.col(flag) if isinstance(flag, str) else flag, 1))


def percent(part: Column | str, whole: Column | str, digits: int) -> Column:
    """``part`` of ``whole`` in percent, rounded half up; null when there is no whole."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.round(F.try_divide(part * 100, whole), digits)


def build_mapping(history: DataFrame, epoch: str | None = "firstseen", sep: str = "->") -> DataFrame:
    """One route per cleaned call sign: the earliest whole flight, and the flight count.

    Without a time column the smallest flight by value is taken, so that the result
    does not depend on file order.
    """
    details = ["dep_airport", "arr_airport", "model", "typecode"]
    valid = valid_history(history)
    seen = F.min(epoch) if epoch else F.lit(0)
    # equal flights are counted first; few remain per call sign
    flights = valid.groupBy("callsign_clean", *details).agg(
        F.count(F.lit(1)).alias("flights"), seen.alias("seen")
    )
    return (
        flights.groupBy("callsign_clean")
        .agg(
            F.min(F.struct(F.isnull("seen"), "seen", *details)).alias("f"),
            F.sum("flights").alias("flight_count"),
        )
        .select(
            F.col("callsign_clean").alias("callsign"),
            F.col("f.dep_airport").alias("departure_airport"),
            F.col("f.arr_airport").alias("arrival_airport"),
            F.col("f.model").alias("aircraft_model"),
            F.col("f.typecode").alias("aircraft_type"),
            "flight_count",
            route_text("f.dep_airport", "f.arr_airport", sep).alias("route"),
        )
    )


# measure of the fact table -> (function, source column)
EXTREMES = {
    "first_seen": ("min", "time"),
    "last_seen": ("max", "time"),
    "first_position_update": ("min", "lastposupdate"),
    "last_position_update": ("max", "lastposupdate"),
    "first_contact": ("min", "lastcontact"),
    "last_contact": ("max", "lastcontact"),
    "max_velocity": ("max", "velocity"),
    "min_velocity": ("min", "velocity"),
    "max_baro_altitude": ("max", "baroaltitude"),
    "min_baro_altitude": ("min", "baroaltitude"),
    "max_geo_altitude": ("max", "geoaltitude"),
    "min_geo_altitude": ("min", "geoaltitude"),
    "max_vertical_rate": ("max", "vertrate"),
    "min_vertical_rate": ("min", "vertrate"),
    "min_latitude": ("min", "lat"),
    "max_latitude": ("max", "lat"),
    "min_longitude": ("min", "lon"),
    "max_longitude": ("max", "lon"),
}
MEANS = {
    "avg_velocity": "velocity",
    "avg_baro_altitude": "baroaltitude",
    "avg_geo_altitude": "geoaltitude",
    "avg_cruise_altitude": "_cruise",
    "avg_vertical_rate": "vertrate",
    "avg_heading": "heading",
    "avg_latitude": "lat",
    "avg_longitude": "lon",
}
FLAGS = {"onground_count": "onground", "alert_count": "alert", "spi_count": "spi"}


def cruise_altitude(vertrate: Column | str = "vertrate", altitude: Column | str = "baroaltitude") -> Column:
    """The altitude while neither climbing nor sinking, else null."""
    return F.when(F.abs(vertrate) < 1, F.col(altitude) if isinstance(altitude, str) else altitude)


def with_durations(fact: DataFrame) -> DataFrame:
    """Seconds, minutes, hours and airborne share from the fact's counts and times."""
    seconds = F.col("last_seen") - F.col("first_seen")
    airborne = F.col("total_data_points") - F.col("onground_count")
    return fact.withColumns(
        {
            "duration_seconds": seconds,
            "duration_minutes": F.round(seconds / 60, 2),
            "duration_hours": F.round(seconds / 3600, 2),
            "airborne_percentage": percent(airborne, "total_data_points", 2),
        }
    )


def first_aircraft(seen: DataFrame) -> DataFrame:
    """Per ``_flight``: the aircraft of its first report and the number of its squawk codes.

    ``seen`` has a row per squawk code and aircraft with the first time ``_seen``, or several.
    """
    return seen.groupBy("_flight").agg(
        F.min(F.struct(F.isnull("_seen"), "_seen", *AIRCRAFT)).alias("_first"),
        F.countDistinct("squawk").alias("unique_squawk_codes"),
    )


def finished_fact(joined: DataFrame) -> DataFrame:
    """The columns of the fact table from measures, first aircraft and distance by ``_flight``."""
    taken = ("_flight", "_first", "unique_squawk_codes", "distance_km")
    fact = joined.select(
        flight_id("_flight.flight_date", "_flight.callsign_clean").alias("flight_id"),
        *[F.col(f"_flight.{c}").alias(c) for c in FLIGHT_KEYS],
        *[c for c in joined.columns if c not in taken],
        *[f"_first.{c}" for c in AIRCRAFT],
        "unique_squawk_codes",
        F.round("distance_km", 6).alias("distance_km"),
    )
    return with_durations(fact)


def fact_flight_history(gold: DataFrame) -> DataFrame:
    """One row per flight (date, call sign, aircraft, route): 35 measures and 4 derived.

    The numeric measures are one hash aggregate. Squawk codes and the aircraft of the
    first report come from a second, narrow branch that is reduced to the distinct
    combinations of a flight before it is merged; kilometres from a third, that sees
    positions only. All end up partitioned by flight, so their joins move nothing. The
    key is a struct, in which missing parts are equal. A flight without any position, or
    without an aircraft, has no distance.
    """
    rows = with_flight_keys(gold).withColumns(
        {"_cruise": cruise_altitude(), "_flight": F.struct(*FLIGHT_KEYS)}
    )
    measures = rows.groupBy("_flight").agg(
        *[getattr(F, f)(c).alias(name) for name, (f, c) in EXTREMES.items()],
        *[F.avg(c).alias(name) for name, c in MEANS.items()],
        F.stddev("velocity").alias("stddev_velocity"),
        *[flagged(c).alias(name) for name, c in FLAGS.items()],
        F.count(F.lit(1)).alias("total_data_points"),
    )
    details = first_aircraft(rows.groupBy("_flight", "squawk", *AIRCRAFT).agg(F.min("time").alias("_seen")))
    known = rows.filter(F.col("icao24").isNotNull())
    flown = tracks.track_distance(known, ["_flight"]).drop("positions")
    return finished_fact(measures.join(details, "_flight").join(flown, "_flight", "left"))


def with_route_id(fact: DataFrame, sep: str = "-") -> DataFrame:
    ends = F.concat_ws(sep, "departure_airport", "arrival_airport")
    return fact.withColumn("route_id", F.coalesce("route", ends))


def onground_share(onground: str, points: str) -> Column:
    """Aggregate: share of reports on the ground, in percent."""
    return F.try_divide(F.sum(onground) * 100.0, F.sum(points)).alias("onground_pct")


def dim_route_analytics(fact: DataFrame, sep: str = "-") -> DataFrame:
    """Per route: mean flight time, speed and cruise altitude, flights, call signs, ground share."""
    return (
        with_route_id(fact, sep)
        .groupBy("route_id", "departure_airport", "arrival_airport")
        .agg(
            F.avg("duration_minutes").alias("avg_flight_time_minutes"),
            F.avg("max_velocity").alias("avg_max_velocity"),
            F.avg("avg_cruise_altitude").alias("avg_cruise_altitude"),
            F.count(F.lit(1)).alias("total_flights"),
            # distinct call signs, not carriers
            F.countDistinct("callsign_clean").alias("unique_callsigns"),
            onground_share("onground_count", "total_data_points"),
        )
    )


#: how the columns of ``utilization_parts`` merge
MERGED_BY = {
    "_first": "min", "_last": "max", "_airborne": "sum", "_max_rate": "max", "_min_rate": "min",
    "_speed": "sum", "_speeds": "sum", "_alt": "max",
}


def utilization_parts(dated: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and call sign: partial rows of the utilization table."""
    return dated.groupBy(*keys, "callsign").agg(
        F.min("time").alias("_first"),
        F.max(F.struct("time", "lat", "lon")).alias("_last"),
        flagged(~F.col("onground")).alias("_airborne"),
        F.max("vertrate").alias("_max_rate"),
        F.min("vertrate").alias("_min_rate"),
        F.sum("velocity").alias("_speed"),
        F.count("velocity").alias("_speeds"),
        F.max("baroaltitude").alias("_alt"),
    )


def utilization(parts: DataFrame, keys: list[str], flown: DataFrame, seconds: int) -> DataFrame:
    """One row per key from one partial row per key and call sign, and the distances by key.

    An aircraft without a name has no distance, so a plain join leaves it without.
    """
    merged = parts.groupBy(*keys).agg(
        F.min(F.struct("_first", "callsign"))["callsign"].alias("callsign"),
        F.sum("_airborne").alias("airborne_data_points"),
        F.count("callsign").alias("number_of_flights"),
        F.max("_max_rate").alias("max_vertical_rate"),
        F.min("_min_rate").alias("min_vertical_rate"),
        F.max("_last")["lat"].alias("last_reported_lat"),
        F.max("_last")["lon"].alias("last_reported_lon"),
        F.try_divide(F.sum("_speed"), F.sum("_speeds")).alias("avg_velocity"),
        F.max("_alt").alias("max_altitude"),
    )
    return merged.join(flown, keys, "left").withColumns(
        {
            "distance_km": F.round("distance_km", 6),
            "estimated_flight_hours": F.round(F.col("airborne_data_points") * seconds / 3600, 2),
        }
    )


def dim_aircraft_utilization(gold: DataFrame) -> DataFrame:
    """Per aircraft and day: activity, vertical rates, last position, kilometres, estimated hours."""
    keys = ["icao24", "flight_date"]
    dated = gold.withColumn("flight_date", utc_date("time"))
    flown = tracks.track_distance(dated, keys).drop("positions")
    return utilization(utilization_parts(dated, keys), keys, flown, SECONDS_PER_POINT)


def with_grid(df: DataFrame, degrees: float = 0.5, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.withColumns({"lat_bin": grid_bin(lat, degrees), "lon_bin": grid_bin(lon, degrees)})


def dim_airspace_heatmap(gold: DataFrame, degrees: float = 0.5, approx: bool = False) -> DataFrame:
    """Per grid cell and hour of day: aircraft, altitude, speed and its spread, points.

    ``velocity_variance`` is a sample standard deviation; the name is kept. ``approx``
    counts aircraft with a sketch and saves one of the two shuffles.
    """
    distinct = F.approx_count_distinct if approx else F.countDistinct
    cells = (
        with_grid(gold, degrees)
        .withColumn("hour_of_day", utc_hour("time"))
        .groupBy("lat_bin", "lon_bin", "hour_of_day")
        .agg(
            distinct("icao24").alias("traffic_density"),
            F.avg("baroaltitude").alias("avg_altitude"),
            F.stddev("velocity").alias("velocity_variance"),
            F.avg("velocity").alias("avg_velocity"),
            F.count(F.lit(1)).alias("data_points"),
        )
    )
    return cells.withColumn("geo_hash", grid_key("lat_bin", "lon_bin"))


def cell_flights(gold: DataFrame, degrees: float = 0.5) -> DataFrame:
    """Per grid cell: distinct flights (call sign and day) and distinct aircraft.

    Two distinct counts in one aggregate would copy every row; here each (cell, flight,
    aircraft) is made once, then counted.
    """
    seen = (
        with_grid(with_flight_keys(gold), degrees)
        .groupBy("lat_bin", "lon_bin", "flight_date", "callsign_clean", "icao24")
        .agg(F.count(F.lit(1)).alias("points"))
    )
    return seen.groupBy("lat_bin", "lon_bin").agg(
        F.countDistinct(flight_id("flight_date", "callsign_clean")).alias("flights"),
        F.countDistinct("icao24").alias("aircraft"),
        F.sum("points").alias("data_points"),
    )


def route_onground_pct(gold: DataFrame) -> DataFrame:
    """Share of reports on the ground, per route."""
    routes = gold.groupBy("departure_airport", "arrival_airport", "route").agg(
        flagged("onground").alias("onground_points"), F.count(F.lit(1)).alias("data_points")
    )
    return routes.withColumn(
        "onground_pct", F.col("onground_points") * 100.0 / F.col("data_points")
    )


def match_rate(df: DataFrame, matched: str = "route") -> DataFrame:
    """Rows, matched rows and their percentage (one decimal; 0 for no rows) in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("records"), F.count(matched).alias("matched")
    ).withColumn("match_rate", F.coalesce(percent("matched", "records", 1), F.lit(0.0)))
