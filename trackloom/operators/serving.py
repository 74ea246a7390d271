"""Serving aggregates over the unified states.

Every aggregate is a merge of partial rows (counts, sums, extremes). A full load takes
the partials of all states; an incremental load takes the partials of the new states
only and merges them with those stored earlier, so old states are not read again.
Merging shares the shuffle of the partial step, as both group by the same keys.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import utc_date, utc_hour

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.col(total), F.col(n))


def _altitude_and_speed(df: DataFrame) -> dict[str, tuple[str, Column]]:
    """Partial sums of altitude and speed; missing columns give nulls."""
    measures = {}
    for name, column in (("altitude", "baro_altitude"), ("velocity", "velocity")):
        value = F.col(column) if column in df.columns else F.lit(None).cast("double")
        measures[f"sum_{name}"] = ("sum", value)
        measures[f"n_{name}"] = ("count", value)
    return measures


_MEANS = {
    "avg_altitude": ("sum_altitude", "n_altitude"),
    "avg_velocity": ("sum_velocity", "n_velocity"),
}


@dataclass(frozen=True)
class ServingTable:
    """How one serving table is computed: partial rows, their merge, the final columns."""

    name: str
    partials: Callable[[DataFrame], DataFrame | None]
    finish: Callable[[DataFrame], DataFrame]

    def build(self, df: DataFrame) -> DataFrame | None:
        parts = self.partials(df)
        return None if parts is None else self.finish(parts)


def _partial(df: DataFrame, keys: list[str], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """Partial rows; the prefix of a column name says how it is merged."""
    return df.groupBy(*keys).agg(
        *[getattr(F, f)(c).alias(f"{f}__{name}") for name, (f, c) in measures.items()]
    )


def _merge(parts: DataFrame) -> DataFrame:
    keys = [c for c in parts.columns if "__" not in c]
    merged = []
    for c in parts.columns:
        if "__" in c:
            how, name = c.split("__", 1)
            merged.append(_MERGE[how](c).alias(name))
    return parts.groupBy(*keys).agg(*merged)


# --- flight summary ------------------------------------------------------------


def _summary_partials(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    measures = {"position_updates": ("count", F.lit(1))}
    optional = {
        "first_seen": ("min", "first_seen"),
        "last_seen": ("max", "last_seen"),
        "max_altitude": ("max", "baro_altitude"),
        "max_velocity": ("max", "velocity"),
        "airline_name": ("max", "airline_name"),
        "origin_code": ("max", "origin_code"),
        "destination_code": ("max", "destination_code"),
    }
    measures |= {n: (f, F.col(c)) for n, (f, c) in optional.items() if c in have}
    sums = _altitude_and_speed(df)
    for column, name in (("baro_altitude", "altitude"), ("velocity", "velocity")):
        if column in have:
            measures |= {k: v for k, v in sums.items() if k.endswith(name)}
    keys = ["icao24"] + [k for k in ("callsign", "origin_country") if k in have]
    return _partial(df, keys, measures)


def _summary_finish(parts: DataFrame) -> DataFrame:
    merged = _merge(parts)
    means = {n: _mean(t, c) for n, (t, c) in _MEANS.items() if t in merged.columns}
    return merged.withColumns(means).drop(*[c for pair in _MEANS.values() for c in pair])


# --- carriers, airports, hours ---------------------------------------------------


def _with_means(merged: DataFrame) -> DataFrame:
    means = {n: _mean(t, c) for n, (t, c) in _MEANS.items()}
    return merged.withColumns(means).drop(*[c for pair in _MEANS.values() for c in pair])


def _airline_partials(df: DataFrame) -> DataFrame | None:
    if "airline_name" not in df.columns:
        return None
    rows = {"total_flights": ("count", F.col("icao24"))}
    named = df.filter(F.col("airline_name").isNotNull())
    return _partial(named, ["airline_name"], rows | _altitude_and_speed(df))


def _airline_finish(parts: DataFrame) -> DataFrame:
    return _with_means(_merge(parts)).orderBy(F.desc("total_flights"), "airline_name")


def _airport_partials(df: DataFrame) -> DataFrame | None:
    """Departures and arrivals from one scan: every state is counted at its route first."""
    ends = [e for e in ("origin", "destination") if f"{e}_code" in df.columns]
    if not ends:
        return None
    columns = [c for e in ends for c in (f"{e}_code", f"{e}_city") if c in df.columns]
    routes = df.groupBy(*columns).agg(F.count("icao24").alias("n"))
    visits = [
        F.struct(
            F.lit(end).alias("end"),
            F.col(f"{end}_code").alias("airport_code"),
            (F.col(f"{end}_city") if f"{end}_city" in columns else F.lit(None).cast("string")).alias("city"),
            F.when(F.lit(end == "origin"), F.col("n")).otherwise(0).alias("sum__departures"),
            F.when(F.lit(end == "destination"), F.col("n")).otherwise(0).alias("sum__arrivals"),
        )
        for end in ends
    ]
    return (
        routes.select(F.explode(F.array(*visits)).alias("v"))
        .select("v.*")
        .filter(F.col("airport_code").isNotNull())
        # one city per airport and kind of visit, as texts may differ between states
        .groupBy("airport_code", "end")
        .agg(
            F.max("city").alias("max__city"),
            F.sum("sum__departures").alias("sum__departures"),
            F.sum("sum__arrivals").alias("sum__arrivals"),
        )
    )


def _airport_finish(parts: DataFrame) -> DataFrame:
    visits = _merge(parts)
    return (
        visits.groupBy("airport_code", "city")
        .agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))
        .withColumn("total_flights", F.col("departures") + F.col("arrivals"))
        .orderBy(F.desc("total_flights"), "airport_code", "city")
    )


def _hourly_partials(df: DataFrame) -> DataFrame | None:
    if "last_contact" not in df.columns:
        return None
    rows = {"total_flights": ("count", F.col("icao24"))}
    # the stored year/month/day/hour columns are of another clock
    timed = df.withColumns({"date": utc_date("last_contact"), "hour": utc_hour("last_contact")})
    return _partial(timed, ["date", "hour"], rows | _altitude_and_speed(df))


def _hourly_finish(parts: DataFrame) -> DataFrame:
    return _with_means(_merge(parts)).orderBy("date", "hour")


FLIGHT_SUMMARY = ServingTable("flight_summary", _summary_partials, _summary_finish)
AIRLINE_STATS = ServingTable("airline_stats", _airline_partials, _airline_finish)
AIRPORT_STATS = ServingTable("airport_stats", _airport_partials, _airport_finish)
HOURLY_STATS = ServingTable("hourly_stats", _hourly_partials, _hourly_finish)
SERVING_TABLES = (FLIGHT_SUMMARY, AIRLINE_STATS, AIRPORT_STATS, HOURLY_STATS)


def flight_summary(df: DataFrame) -> DataFrame:
    """Per aircraft, call sign and country; only measures whose columns are present."""
    return FLIGHT_SUMMARY.build(df)


def airline_stats(df: DataFrame) -> DataFrame | None:
    """Per carrier: position rows (``total_flights``), mean altitude and speed."""
    return AIRLINE_STATS.build(df)


def airport_stats(df: DataFrame) -> DataFrame | None:
    """Per airport and city: departures, arrivals and their sum, counted in position rows."""
    return AIRPORT_STATS.build(df)


def hourly_stats(df: DataFrame) -> DataFrame | None:
    """Per day and hour of last contact: position rows, mean altitude and speed."""
    return HOURLY_STATS.build(df)
