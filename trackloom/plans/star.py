"""The merged table to the star schema, as a whole or load by load."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import increments
from ..operators.codes import new_codes
from ..operators.filters import telemetry_projection
from ..operators.merge import sample_fraction
from ..operators.star import (
    dim_aircraft_utilization,
    dim_airspace_heatmap,
    dim_route_analytics,
    fact_flight_history,
)
from ..sinks import counted, folders, put, remove, replace_batch, write_partitioned
from ..sources.files import read_optional
from ..sources.jdbc import write_jdbc

STAR_TABLES = (
    "fact_flight_history", "dim_route_analytics", "dim_aircraft_utilization",
    "dim_airspace_heatmap", "raw_telemetry",
)


def star_job(
    spark: SparkSession,
    gold_path: str,
    star_path: str,
    sample: float | None = None,
    publish: Callable[[DataFrame, str], int] | None = None,
) -> dict[str, int]:
    """Writes the five tables below ``star_path`` and returns their row counts.

    Each table scans only the gold columns it needs; the route dimension is built from
    the stored fact table. Nothing is cached and every table is one write. ``publish``
    (such as ``jdbc_publisher``) gets each stored table for a database. ``raw_telemetry``
    has every report; with ``sample`` that fraction of it is stored as a sixth table.
    """
    gold = spark.read.parquet(gold_path)
    rows: dict[str, int] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        out, written = counted(df)
        out.write.mode("overwrite").parquet(f"{star_path}/{name}")
        rows[name] = written.get["rows"]
        stored = spark.read.parquet(f"{star_path}/{name}")
        if publish is not None:
            publish(stored, name)
        return stored

    fact = store("fact_flight_history", fact_flight_history(gold))
    store("dim_route_analytics", dim_route_analytics(fact))
    store("dim_aircraft_utilization", dim_aircraft_utilization(gold))
    store("dim_airspace_heatmap", dim_airspace_heatmap(gold))
    telemetry = store("raw_telemetry", telemetry_projection(gold))
    if sample is not None:
        store("raw_telemetry_sample", sample_fraction(telemetry, sample, ("icao24", "time")))
    return rows


def jdbc_publisher(options: dict[str, str], mode: str = "overwrite") -> Callable[[DataFrame, str], int]:
    """A ``publish`` function that writes each table over JDBC."""
    return lambda df, name: write_jdbc(df, name, options, mode)


#: star table -> the partial tables it is merged from
_PARTIALS = {
    "fact_flight_history": ("flights", "details", "tracks"),
    "dim_route_analytics": ("flights", "details", "tracks"),
    "dim_aircraft_utilization": ("aircraft", "tracks"),
    "dim_airspace_heatmap": ("cells",),
    "raw_telemetry": (),
}


_CODES = "value string, code long"


def _grown(spark: SparkSession, path: str, values: DataFrame) -> DataFrame:
    """The dictionary at ``path`` with codes for all ``values``. Codes once given stay."""
    known = read_optional(spark, path, _CODES)
    new_codes(values, known).write.mode("append").parquet(path)
    return spark.read.schema(_CODES).parquet(path)


def _months(parts: DataFrame) -> set[str]:
    return {r.month for r in parts.select("month").distinct().collect()}


def star_load(
    spark: SparkSession,
    gold: DataFrame,
    star_path: str,
    batch: str,
    tables: Sequence[str] = STAR_TABLES,
    refresh: bool = True,
) -> dict[str, int]:
    """Takes the reports of one load into the star tables; earlier loads are not read again.

    The load's partial rows are stored under its id, and the months that they touch are merged
    anew from the partial rows of all loads. A load that is repeated under its id replaces its
    own rows and nothing else; reports may come in any order and any late. ``read_star`` reads
    the tables. Returns the months that the load touches, and its reports if they are
    stored; one load runs at a time. Months, of which there are few, are the only values that
    pass the driver. A backlog of loads that touch the same months is quicker taken in with
    ``refresh=False`` and one ``refresh_star`` at its end: the months are marked and merged once.
    """
    root = f"{star_path}/_partials"
    frames = _frames(spark, gold, star_path, tables)
    wanted = _wanted(tables)
    layouts = {name: frames[name].schema.add("batch", "string") for name in wanted}
    mine = F.col("batch") == batch
    touched: set[str] = set()
    for name in wanted:
        path = f"{root}/{name}"
        before = read_optional(spark, path, layouts[name])
        if before is not None:
            touched |= _mark(spark, star_path, tables, _months(before.filter(mine)))
        replace_batch(frames[name], path, batch, ("month",))
        touched |= _mark(spark, star_path, tables, _months(spark.read.schema(layouts[name]).parquet(path).filter(mine)))
    figures = {"months": len(touched)}
    if "raw_telemetry" in tables:
        load, written = counted(telemetry_projection(gold))
        replace_batch(load, f"{star_path}/raw_telemetry", batch)
        figures["records"] = written.get["rows"]
    if refresh:
        refresh_star(spark, gold, star_path, tables)
    return figures


def refresh_star(spark: SparkSession, gold: DataFrame, star_path: str, tables: Sequence[str] = STAR_TABLES) -> int:
    """Merges anew the months that loads touched since they were last merged; returns their number.

    ``gold`` gives the columns of the reports; its rows are not read. A month stays marked until its
    tables are written, so a run that breaks off is made up for by the next one.
    """
    layouts = {name: f.schema.add("batch", "string") for name, f in _frames(spark, gold, star_path, tables, grow=False).items()}
    layouts = {name: layouts[name] for name in _wanted(tables)}
    marks = _marks(spark, star_path, tables)
    months = sorted({m.rsplit("/", 1)[1] for m in marks})
    if months:
        _refresh(spark, star_path, layouts, months, tables)
        remove(spark, *marks)
    return len(months)


def _wanted(tables: Sequence[str]) -> list[str]:
    return sorted({p for t in tables for p in _PARTIALS[t]})


def _frames(
    spark: SparkSession, gold: DataFrame, star_path: str, tables: Sequence[str], grow: bool = True
) -> dict[str, DataFrame]:
    """The partial rows of a load; without ``grow`` only their columns are meant."""
    frames = {
        "flights": increments.flight_partials(gold),
        "details": increments.detail_partials(gold),
        "tracks": increments.track_partials(gold),
        "aircraft": increments.aircraft_partials(gold),
    }
    if "dim_airspace_heatmap" in tables:
        path = f"{star_path}/_codes/icao24"
        aircraft = (
            _grown(spark, path, gold.select(F.col("icao24").alias("value")))
            if grow
            else spark.read.schema(_CODES).parquet(path)
        )
        frames["cells"] = increments.cell_partials(gold, aircraft)
    return frames


# a month that waits to be merged has an empty file _stale/<table>/<month>


def _mark(spark: SparkSession, star_path: str, tables: Sequence[str], months: set[str]) -> set[str]:
    for table in tables:
        for month in months:
            put(spark, f"{star_path}/_stale/{table}/{month}", b"")
    return months


def _marks(spark: SparkSession, star_path: str, tables: Sequence[str]) -> list[str]:
    return [m for table in tables for m in folders(spark, f"{star_path}/_stale/{table}/*")]


def _refresh(
    spark: SparkSession, star_path: str, layouts: dict[str, StructType], months: Sequence[str], tables: Sequence[str]
) -> None:
    """Merges the partial rows of ``months`` anew."""
    root = f"{star_path}/_partials"

    def parts(name: str) -> DataFrame:
        stored = spark.read.schema(layouts[name]).parquet(f"{root}/{name}")
        return stored.filter(F.col("month").isin(*months)).drop("batch")

    # a month whose last reports a repeated load took away has no partial rows
    gone = set(months).difference(*[_months(parts(name)) for name in layouts])

    def store(df: DataFrame, path: str) -> DataFrame:
        write_partitioned(df, path, "overwrite_partitions", ("month",), cluster=True)
        for month in gone:
            df.filter("false").drop("month").write.mode("overwrite").parquet(f"{path}/month={month}")
        return spark.read.schema(df.schema).parquet(path)

    if "flights" in layouts:
        fact = store(
            increments.merged_flights(parts("flights"), parts("details"), parts("tracks")),
            f"{star_path}/fact_flight_history",
        ).filter(F.col("month").isin(*months))
    if "dim_route_analytics" in tables:
        signs = _grown(spark, f"{star_path}/_codes/callsign", fact.select(F.col("callsign_clean").alias("value")))
        routes = store(increments.route_partials(fact, signs), f"{root}/routes")
        increments.merged_routes(routes).write.mode("overwrite").parquet(f"{star_path}/dim_route_analytics")
    if "aircraft" in layouts:
        merged = increments.merged_aircraft(parts("aircraft"), parts("tracks"))
        store(merged, f"{star_path}/dim_aircraft_utilization")
    if "cells" in layouts:
        cells = store(increments.merged_cells(parts("cells")), f"{root}/cell_months")
        increments.heatmap(cells).write.mode("overwrite").parquet(f"{star_path}/dim_airspace_heatmap")


def read_star(spark: SparkSession, star_path: str, table: str) -> DataFrame:
    """A table kept by ``star_load``, with the columns that ``star_job`` gives it."""
    stored = spark.read.parquet(f"{star_path}/{table}")
    return stored.drop("batch" if table == "raw_telemetry" else "month")
