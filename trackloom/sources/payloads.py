"""JSON payloads of the live feed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

# slot number -> column and type of a positional report: the live layout without its
# last column, which is added on arrival
_SLOTS = [f for f in schemas.fields(schemas.LIVE_STATES) if f[0] != "ingestion_time"]


def parse_json(df: DataFrame, schema: str = schemas.LIVE_STATES, value: str = "value") -> DataFrame:
    """Bytes or text of a JSON object to columns; malformed text gives a row of nulls."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("s")).select("s.*")


def to_json_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """The whole row as JSON ``value``, with ``key`` as message key when given."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def parse_state_vectors(
    df: DataFrame, payload: str = "payload", ingestion_time: Column | None = None
) -> DataFrame:
    """Arrays of positional reports to named, typed columns.

    ``payload`` is JSON text, an array of arrays. Reports with fewer than 17 slots
    are dropped; slots that cannot be cast become null.
    """
    now = F.current_timestamp().cast("string") if ingestion_time is None else ingestion_time
    reports = df.select(
        *[c for c in df.columns if c != payload],
        F.explode(F.from_json(payload, "array<array<string>>")).alias("_slots"),
    ).filter(F.size("_slots") >= len(_SLOTS))
    kept = [c for c in reports.columns if c != "_slots"]
    typed = [
        F.get("_slots", F.lit(i)).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(_SLOTS)
    ]
    return reports.select(*kept, *typed, now.alias("ingestion_time"))
