"""Route tables from CSV files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.lookup import exact_route_table, route_schedule
from . import dims
from .files import strip_column_names, with_line_order

LINE_ORDER = ["_file", "_block", "_line"]


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns as text, with the order of its lines."""
    return strip_column_names(with_line_order(spark.read.option("header", True).csv(path)))


def read_exact_routes(spark: SparkSession, path: str) -> DataFrame:
    """``callsign, origin, destination, …``; of several lines for a call sign the last wins."""
    return exact_route_table(_read_lines(spark, path), LINE_ORDER)


def read_route_schedule(
    spark: SparkSession, path: str, last_wins: bool = False, known_only: bool = False
) -> DataFrame:
    """``FlightNo, Origin, Destination, …`` as routes by call sign.

    ``last_wins`` settles repeated call signs by line order instead of by value.
    """
    return route_schedule(
        _read_lines(spark, path),
        dims.schedule_carriers(spark),
        dims.airports(spark),
        known_only,
        LINE_ORDER if last_wins else (),
    )


def schedule_or_rules(spark: SparkSession, path: str) -> DataFrame:
    """Routes of the schedule file; the number-range rules when there is no such file."""
    try:
        return read_route_schedule(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return dims.route_rules(spark)
        raise
