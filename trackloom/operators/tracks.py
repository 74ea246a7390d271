"""Measures along an object's track.

A stretch of a track is summed up by its first position, its last position and the kilometres
between them. Two stretches that follow each other merge into one by adding the gap, so reports can
be summed by bucket, bucket by bucket into days, and days into longer tracks, in any grouping.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import haversine_km

BUCKET_SECONDS = 600


def positions(
    df: DataFrame,
    keys: Sequence[str],
    epoch: str = "time",
    lat: str = "lat",
    lon: str = "lon",
    bucket_seconds: int = BUCKET_SECONDS,
    known: str | None = "icao24",
) -> DataFrame:
    """``keys``, time bucket and position of every report that has one and belongs to an object."""
    if known in keys:
        df = df.filter(F.col(known).isNotNull())
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        *keys,
        F.floor(F.col(epoch) / bucket_seconds).alias("_bucket"),
        F.struct(F.col(epoch).alias("_t"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).alias("_point"),
    )


def bucket_points(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The positions of each bucket of a track in one row; rows of several loads merge."""
    return placed.groupBy(*keys, "_bucket").agg(F.collect_list("_point").alias("_points"))


def _along(stops: Column, km: Column, step) -> Column:
    """``km`` and the steps between neighbours of an array."""
    n = F.size(stops)
    steps = F.zip_with(F.slice(stops, 1, F.greatest(n - 1, F.lit(0))), F.slice(stops, 2, F.greatest(n - 1, F.lit(0))), step)
    return F.reduce(steps, km, lambda total, s: total + s)


def _km(a: Column, b: Column) -> Column:
    return haversine_km(a["_lat"], a["_lon"], b["_lat"], b["_lon"])


def stretches(points: DataFrame, keys: Sequence[str], merge: bool = False) -> DataFrame:
    """Each bucket as a stretch: first and last position, kilometres, number of positions.

    With ``merge`` a bucket's points may be spread over several rows.
    """
    if merge:
        points = points.groupBy(*keys, "_bucket").agg(F.flatten(F.collect_list("_points")).alias("_points"))
    ordered = points.withColumn("_points", F.array_sort("_points"))
    return ordered.select(
        *keys,
        F.struct(
            F.col("_points")[0].alias("_first"),
            F.element_at("_points", -1).alias("_last"),
            _along(F.col("_points"), F.lit(0.0), _km).alias("_km"),
            F.size("_points").cast("long").alias("_n"),
        ).alias("_stretch"),
    )


def joined_stretches(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``distance_km`` and ``positions`` per track, from stretches that do not overlap in time."""
    km = F.reduce("_stretches", F.lit(0.0), lambda total, s: total + s["_km"])
    return (
        parts.groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_stretch")).alias("_stretches"))
        .select(
            *keys,
            _along(F.col("_stretches"), km, lambda a, b: _km(a["_last"], b["_first"])).alias("distance_km"),
            F.reduce("_stretches", F.lit(0).cast("long"), lambda total, s: total + s["_n"]).alias("positions"),
        )
    )


def track_distance(
    df: DataFrame,
    keys: Sequence[str] = ("icao24",),
    epoch: str = "time",
    lat: str = "lat",
    lon: str = "lon",
    bucket_seconds: int = BUCKET_SECONDS,
    known: str | None = "icao24",
) -> DataFrame:
    """Kilometres flown and positions per track: the sum of steps between reports.

    Steps are taken inside time buckets of a track, then between the last position of
    one bucket and the first of the next. A track of any length is thus spread over
    many tasks; the second step sees one row per bucket. Reports without a position are
    left out; equal times are ordered by position. Reports whose ``known`` key is null
    belong to no object and are left out as well.
    """
    keys = list(keys)
    placed = positions(df, keys, epoch, lat, lon, bucket_seconds, known)
    return joined_stretches(stretches(bucket_points(placed, keys), keys), keys)
