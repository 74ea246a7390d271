"""Batch and live reports in one layout; unions, duplicates and samples."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import with_date_parts
from ..reference_data import STATE_KEY

# unified column -> batch column, where the names differ
BATCH_NAMES = {
    "timestamp": "time",
    "last_contact": "lastcontact",
    "time_position": "lastposupdate",
    "latitude": "lat",
    "longitude": "lon",
    "baro_altitude": "baroaltitude",
    "geo_altitude": "geoaltitude",
    "on_ground": "onground",
    "true_track": "heading",
    "vertical_rate": "vertrate",
    "origin_code": "departure_airport",
    "destination_code": "arrival_airport",
}
# unified columns that the batch layer does not have
_NOT_IN_BATCH = {
    "position_source", "origin_city", "destination_city", "airline_name", "airline_icao",
    "origin_country", "hour", "ingestion_time", "first_seen", "last_seen",
}
_NOT_IN_SPEED = {"route", "aircraft_model", "aircraft_type"}


def _unify(source: str, names: dict[str, str], constants: dict[str, Column], missing: set[str]):
    """Select list of the unified layout for one layer."""
    columns = []
    for name, kind in schemas.fields(schemas.UNIFIED_STATES):
        if name == "data_source":
            value = F.lit(source)
        elif name in constants:
            value = constants[name]
        elif name in missing:
            value = F.lit(None)
        else:
            value = F.col(names.get(name, name))
        columns.append(value.cast(kind).alias(name))
    return columns


def normalize_batch(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Enriched batch states in the unified layout; ``extra`` columns are kept behind it."""
    return df.select(
        *_unify("batch", BATCH_NAMES, {"position_count": F.lit(1)}, _NOT_IN_BATCH), *extra
    )


def normalize_speed(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Enriched live states in the unified layout."""
    return df.select(*_unify("speed", {"timestamp": "time_position"}, {}, _NOT_IN_SPEED), *extra)


def merge_unified(batch: DataFrame | None, speed: DataFrame | None) -> DataFrame | None:
    """Both layers in the unified layout; either may be missing."""
    parts = []
    if batch is not None:
        parts.append(normalize_batch(batch))
    if speed is not None:
        parts.append(normalize_speed(speed))
    if len(parts) == 2:
        return parts[0].unionByName(parts[1])
    return parts[0] if parts else None


def speed_as_states(speed: DataFrame, sep: str = "->") -> DataFrame:
    """Live states under the column names and types of the batch layer."""
    batch_types = dict(schemas.fields(schemas.STATES))
    renamed = speed.withColumnsRenamed(
        {"time_position": "time"}
        | {u: b for u, b in BATCH_NAMES.items() if u not in ("timestamp", "time_position")}
    )
    out = renamed.withColumns(
        {c: F.col(c).cast(t) for c, t in batch_types.items() if c in renamed.columns}
        | {"lastposupdate": F.col("time").cast("double")}
    )
    if "route" not in out.columns:
        out = out.withColumn("route", F.concat_ws(sep, "departure_airport", "arrival_airport"))
        both = F.col("departure_airport").isNotNull() & F.col("arrival_airport").isNotNull()
        out = out.withColumn("route", F.when(both, F.col("route")))
    if not {"year", "month", "day"} <= set(out.columns):
        out = with_date_parts(out, "time")
    return out


def merge_gold(batch: DataFrame | None, speed: DataFrame | None) -> DataFrame | None:
    """Both layers as one table with batch column names, ready for the star schema.

    Live rows are renamed first, so that their time, position and route land in the
    columns the star schema reads; columns that one side lacks become null.
    """
    parts = []
    if batch is not None:
        parts.append(batch.withColumn("data_source", F.lit("batch")))
    if speed is not None:
        parts.append(speed_as_states(speed).withColumn("data_source", F.lit("speed")))
    if len(parts) == 2:
        return parts[0].unionByName(parts[1], allowMissingColumns=True)
    return parts[0] if parts else None


def _one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick):
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)
    return (
        df.groupBy(*keys)
        .agg(pick(ranked).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def dedup(
    df: DataFrame,
    keys: Sequence[str] = STATE_KEY,
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """One whole row per key: the lowest in ``order``, then by the remaining columns.

    A minimum over row structs is an ordinary aggregate with a map-side step, so a key
    with very many copies is reduced before the shuffle. Null keys are a key of their own.
    """
    return _one_row_per_key(df, keys, order, F.min)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ("time",)
) -> DataFrame:
    """One whole row per key: the highest in ``order``, then by the remaining columns."""
    return _one_row_per_key(df, keys, order, F.max)


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows per group, numbered from 1.

    Spark cuts every group to ``k`` rows in each task before the shuffle, so a very
    large group does not meet in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(ranked)).filter(F.col(rank) <= k)


def sample_fraction(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """The rows whose keys hash below ``fraction``: all rows of a key or none.

    The hash is the first 32 bits of md5, so the same rows are taken on any cluster and
    whatever the size of the table. A null key is hashed as empty text.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("the fraction is between 0 and 1")
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    below = F.substring(F.md5(text), 1, 8) < f"{round(fraction * 16**8):08x}"
    return df if fraction == 1 else df.filter(below)
