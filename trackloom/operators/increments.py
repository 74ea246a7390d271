"""Partial rows of the star tables: what a load stores, so that later loads need not read it again.

Counts, sums and extremes add up. Spreads are kept as moments (count, mean, sum of squared
differences), which merge without the loss of digits that sums of squares have. Distinct counts are
bitmaps, squawk codes and first reports rows per value, positions lie in their time bucket. A row
of a report that comes late merges like any other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import utc_date, utc_hour, with_flight_keys
from ..reference_data import SECONDS_PER_POINT
from . import star, tracks
from .codes import bitmap_group, bitmap_of

AIRCRAFT_KEYS = ["icao24", "flight_date"]
CELL_KEYS = ["lat_bin", "lon_bin", "hour_of_day"]
ROUTE_KEYS = ["route_id", "departure_airport", "arrival_airport"]


def moments(value: Column | str) -> Column:
    """Aggregate: count, mean and sum of squared differences from it."""
    n = F.count(value)
    return F.struct(
        n.alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"),
    )


def merged_moments(parts: Column | str) -> Column:
    """Aggregate over moments, pair by pair."""

    def pair(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        share = F.when(n > 0, b["n"] / n).otherwise(0.0)
        return F.struct(
            n.alias("n"), (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
        )

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.reduce(F.collect_list(parts), none, pair)


def sample_stddev(m: Column) -> Column:
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))


def month_of(date: Column | str) -> Column:
    """The folder of a date's partial rows, as text that no reader takes for a date.

    Missing dates share one.
    """
    return F.coalesce(F.date_format(date, "'m'yyyy-MM"), F.lit("none"))


def _sums(means: dict[str, str]) -> list[Column]:
    return [a for name, c in means.items() for a in (F.sum(c).alias(f"sum_{name}"), F.count(c).alias(f"n_{name}"))]


def _merged_means(means) -> list[Column]:
    return [F.try_divide(F.sum(f"sum_{n}"), F.sum(f"n_{n}")).alias(n) for n in means]


def _keyed(gold: DataFrame) -> DataFrame:
    keyed = with_flight_keys(gold).withColumns({"_cruise": star.cruise_altitude()})
    return keyed.withColumn("month", month_of("flight_date"))


# --- flights -------------------------------------------------------------------


def flight_partials(gold: DataFrame) -> DataFrame:
    """Per month and flight: the numeric measures of the fact table."""
    return _keyed(gold).groupBy("month", *star.FLIGHT_KEYS).agg(
        *[getattr(F, f)(c).alias(name) for name, (f, c) in star.EXTREMES.items()],
        *_sums(star.MEANS),
        moments("velocity").alias("speed"),
        *[star.flagged(c).alias(name) for name, c in star.FLAGS.items()],
        F.count(F.lit(1)).alias("total_data_points"),
    )


def detail_partials(gold: DataFrame) -> DataFrame:
    """Per month and flight: its squawk codes and aircraft, with the first time of each."""
    return _keyed(gold).groupBy("month", *star.FLIGHT_KEYS, "squawk", *star.AIRCRAFT).agg(F.min("time").alias("_seen"))


def track_partials(gold: DataFrame) -> DataFrame:
    """Per month and flight: the positions of each time bucket."""
    keys = ["month", *star.FLIGHT_KEYS]
    return tracks.bucket_points(tracks.positions(_keyed(gold), keys), keys)


def merged_flights(flights: DataFrame, details: DataFrame, points: DataFrame) -> DataFrame:
    """``month`` and the columns of the fact table."""
    key = F.struct("month", *star.FLIGHT_KEYS).alias("_flight")  # in a struct missing parts are equal
    measures = flights.groupBy(key).agg(
        *[getattr(F, f)(name).alias(name) for name, (f, _) in star.EXTREMES.items()],
        *_merged_means(star.MEANS),
        sample_stddev(merged_moments("speed")).alias("stddev_velocity"),
        *[F.sum(name).alias(name) for name in (*star.FLAGS, "total_data_points")],
    )
    found = star.first_aircraft(details.withColumn("_flight", key))
    flown = tracks.stretches(points.withColumn("_flight", key), ["_flight"], merge=True)
    flown = tracks.joined_stretches(flown, ["_flight"]).drop("positions")
    fact = measures.join(found, "_flight").join(flown, "_flight", "left")
    return star.finished_fact(fact).withColumn("month", month_of("flight_date"))


# --- aircraft ------------------------------------------------------------------


def aircraft_partials(gold: DataFrame) -> DataFrame:
    """Per month, aircraft, day and call sign: what the utilization table merges."""
    dated = gold.withColumn("flight_date", utc_date("time")).withColumn("month", month_of("flight_date"))
    return star.utilization_parts(dated, ["month", *AIRCRAFT_KEYS])


def merged_aircraft(parts: DataFrame, points: DataFrame) -> DataFrame:
    """``month`` and the columns of the utilization table."""
    keys = ["month", *AIRCRAFT_KEYS]
    by_sign = parts.groupBy(*keys, "callsign").agg(
        *[getattr(F, star.MERGED_BY[c])(c).alias(c) for c in parts.columns if c not in (*keys, "callsign")]
    )
    flown = tracks.joined_stretches(tracks.stretches(points, keys, merge=True), keys).drop("positions")
    return star.utilization(by_sign, keys, flown, SECONDS_PER_POINT)


# --- cells ---------------------------------------------------------------------


def cell_partials(gold: DataFrame, aircraft: DataFrame, degrees: float = 0.5) -> DataFrame:
    """Per month, cell, hour of day and bitmap group: the aircraft seen, and the measures.

    ``aircraft`` is a dictionary (value, code) that has every aircraft of ``gold``.
    """
    rows = star.with_grid(gold, degrees).withColumns(
        {"hour_of_day": utc_hour("time"), "month": month_of(utc_date("time"))}
    )
    coded = rows.join(aircraft.withColumnRenamed("value", "icao24"), "icao24", "left")
    return coded.groupBy("month", *CELL_KEYS, bitmap_group("code").alias("group")).agg(
        bitmap_of("code").alias("seen"),
        *_sums({"avg_altitude": "baroaltitude"}),
        moments("velocity").alias("speed"),
        F.count(F.lit(1)).alias("data_points"),
    )


def merged_cells(parts: DataFrame, by_month: bool = True) -> DataFrame:
    """Partial rows of several loads as one row per month (or none), cell, hour and group."""
    return parts.groupBy(*(["month"] if by_month else []), *CELL_KEYS, "group").agg(
        F.bitmap_or_agg("seen").alias("seen"),
        *[F.sum(c).alias(c) for c in ("sum_avg_altitude", "n_avg_altitude", "data_points")],
        merged_moments("speed").alias("speed"),
    )


def heatmap(parts: DataFrame) -> DataFrame:
    """The heat map from partial rows of any months."""
    cells = merged_cells(parts, by_month=False).groupBy(*CELL_KEYS).agg(
        F.sum(F.bitmap_count("seen")).alias("traffic_density"),
        *_merged_means(["avg_altitude"]),
        merged_moments("speed").alias("speed"),
        F.sum("data_points").alias("data_points"),
    )
    speed = F.col("speed")
    return cells.select(
        *CELL_KEYS, "traffic_density", "avg_altitude",
        sample_stddev(speed).alias("velocity_variance"),
        F.when(speed["n"] > 0, speed["mean"]).alias("avg_velocity"),
        "data_points",
        star.grid_key("lat_bin", "lon_bin").alias("geo_hash"),
    )


# --- routes --------------------------------------------------------------------

_ROUTE_MEANS = {
    "avg_flight_time_minutes": "duration_minutes",
    "avg_max_velocity": "max_velocity",
    "avg_cruise_altitude": "avg_cruise_altitude",
}


def route_partials(fact: DataFrame, callsigns: DataFrame) -> DataFrame:
    """Per month, route and bitmap group: call signs seen, and the measures of its flights.

    ``fact`` has its column ``month``; ``callsigns`` is a dictionary of its call signs.
    """
    coded = star.with_route_id(fact).join(callsigns.withColumnRenamed("value", "callsign_clean"), "callsign_clean", "left")
    return coded.groupBy("month", *ROUTE_KEYS, bitmap_group("code").alias("group")).agg(
        bitmap_of("code").alias("seen"),
        *_sums(_ROUTE_MEANS),
        F.sum("onground_count").alias("onground"),
        F.sum("total_data_points").alias("points"),
        F.count(F.lit(1)).alias("total_flights"),
    )


def merged_routes(parts: DataFrame) -> DataFrame:
    """The route dimension from partial rows of any months."""
    added = [f"{p}_{n}" for n in _ROUTE_MEANS for p in ("sum", "n")] + ["onground", "points", "total_flights"]
    groups = parts.groupBy(*ROUTE_KEYS, "group").agg(
        F.bitmap_or_agg("seen").alias("seen"), *[F.sum(c).alias(c) for c in added]
    )
    return groups.groupBy(*ROUTE_KEYS).agg(
        *_merged_means(_ROUTE_MEANS),
        F.sum("total_flights").alias("total_flights"),
        F.sum(F.bitmap_count("seen")).alias("unique_callsigns"),
        star.onground_share("onground", "points"),
    )
