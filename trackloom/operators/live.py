"""The latest state of every object, and figures over it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import has_text


def accumulate(
    df: DataFrame, key: str = "icao24", epoch: str = "time", ties: Sequence[str] = ()
) -> DataFrame:
    """Per key the latest whole row, with first and last time seen and the row count.

    One definition for tables and streams. It is a plain aggregate, reduced before the
    shuffle; the order of arrival does not matter. Equal times are settled by ``ties``,
    then by the other columns. Rows without a key are dropped.
    """
    rest = [c for c in df.columns if c not in (key, epoch, *ties)]
    latest = F.max(F.struct(epoch, *ties, *rest))
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            latest.alias("_latest"),
            F.min(epoch).alias("first_seen"),
            F.max(epoch).alias("last_seen"),
            F.count(F.lit(1)).alias("position_count"),
        )
        .select(
            key, *[f"_latest.{c}" for c in (epoch, *ties, *rest)],
            "first_seen", "last_seen", "position_count",
        )
    )


def live_totals(state: DataFrame, on_ground: str = "on_ground") -> DataFrame:
    """Objects in all, in the air and on the ground; a missing flag counts as in the air."""
    grounded = F.count(F.when(F.col(on_ground), 1))
    total = F.count(F.lit(1))
    return state.agg(
        total.alias("total"), (total - grounded).alias("in_air"), grounded.alias("on_ground")
    )


def accumulator_totals(state: DataFrame) -> DataFrame:
    """Messages taken in, how many were updates, and how many were new objects."""
    return state.agg(
        F.sum("position_count").alias("total_messages"),
        F.sum(F.col("position_count") - 1).alias("updates"),
        F.count(F.lit(1)).alias("new_flights"),
    )


def live_by_country(state: DataFrame, country: str = "origin_country") -> DataFrame:
    return state.groupBy(F.coalesce(country, F.lit("Unknown")).alias("country")).agg(
        F.count(F.lit(1)).alias("flights")
    )


def live_by_airline(state: DataFrame, airline: str = "airline_name") -> DataFrame:
    return (
        state.filter(has_text(airline))
        .groupBy(airline)
        .agg(F.count(F.lit(1)).alias("flights"))
    )


def live_top_routes(
    state: DataFrame,
    k: int = 10,
    origin: str = "origin_code",
    destination: str = "destination_code",
    sep: str = "-",
) -> DataFrame:
    """The ``k`` routes with the most objects; equal counts in order of the route text."""
    routed = state.filter(
        has_text(origin) & has_text(destination) & (F.col(origin) != "UNK")
    )
    return (
        routed.groupBy(F.concat_ws(sep, origin, destination).alias("route"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .orderBy(F.desc("flights"), "route")
        .limit(k)
    )
