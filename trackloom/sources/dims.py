"""The fixed reference tables as DataFrames.

They are built from Arrow tables, which Spark keeps as local relations: their
exact size is known to Catalyst, so joins with them are broadcast joins without a
hint, in batch and on streams.
"""

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .. import reference_data as ref
from ..schemas import fields

_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """A small constant table with an explicit layout."""
    layout = fields(ddl)
    columns = list(zip(*rows)) or [()] * len(layout)
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, layout)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in layout]))


def airlines(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark,
        ref.AIRLINES,
        "airline_icao string, airline_name string, airline_iata string",
    )


def schedule_carriers(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark,
        ref.SCHEDULE_CARRIERS,
        "airline_iata string, airline_name string, airline_prefix string",
    )


def airports(spark: SparkSession, codes: Sequence[str] | None = None) -> DataFrame:
    rows = [a for a in ref.AIRPORTS if codes is None or a[0] in codes]
    return literal_rows(
        spark, rows, "code string, name string, city string, lat double, lon double"
    )


def hybrid_airports(spark: SparkSession) -> DataFrame:
    rows = [
        (code, name, city, *ref.HYBRID_COORDINATES.get(code, (lat, lon)))
        for code, name, city, lat, lon in ref.AIRPORTS
        if code in ref.HYBRID_AIRPORT_CODES
    ]
    return literal_rows(
        spark, rows, "code string, name string, city string, lat double, lon double"
    )


def number_range_rules(spark: SparkSession) -> DataFrame:
    """Rules in their order of precedence."""
    rows = [(rank, *rule) for rank, rule in enumerate(ref.NUMBER_RANGE_RULES)]
    return literal_rows(
        spark,
        rows,
        "rule_rank int, airline_prefix string, min_flight_num int, max_flight_num int, "
        "origin_code string, destination_code string",
    )


def exact_routes(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, ref.EXACT_ROUTES, "callsign string, origin_code string, destination_code string"
    )


def route_rules(spark: SparkSession) -> DataFrame:
    """Number-range rules with carrier and airport attributes of both ends.

    Put together from the fixed values, not by joins: a join of local relations has no
    exact size, and the planner would then shuffle the reports by their few prefixes.
    """
    carriers = {icao: (name, iata, icao) for icao, name, iata in ref.AIRLINES}
    places = {code: (code, city, name, lat, lon) for code, name, city, lat, lon in ref.AIRPORTS}
    rows = [
        (rank, prefix, low, high, *carriers[prefix], *places[origin], *places[destination])
        for rank, (prefix, low, high, origin, destination) in enumerate(ref.NUMBER_RANGE_RULES)
    ]
    ends = ", ".join(
        f"{end}_code string, {end}_city string, {end}_airport string, "
        f"{end}_lat double, {end}_lon double"
        for end in ("origin", "destination")
    )
    return literal_rows(
        spark,
        rows,
        "rule_rank int, airline_prefix string, min_flight_num int, max_flight_num int, "
        f"airline_name string, airline_iata string, airline_icao string, {ends}",
    )
