"""The registered queries. Each takes (spark, folder of tables) and returns a DataFrame."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import reference_data as ref
from .. import schemas
from ..operators import filters, live, lookup, merge, serving, sites, star, tracks
from ..operators.ops import folder_metrics, log_summary
from ..plans.layers import bronze_job, gold_job, mapping_job, silver_job
from ..plans.live import live_job
from ..plans.ops import ops_job
from ..plans.serving import serving_job
from ..plans.star import read_star, refresh_star, star_job, star_load
from ..sinks import export_csv, put, upsert_ledger, write_partitioned, write_tar_csv
from ..sources import dims, files, payloads
from ..sources.logs import read_logs
from ..streaming.enrich import start_enrichment
from ..streaming.serve import serving_table, start_serving, stored_states
from ..streaming.state import (
    late_reports,
    merge_state,
    publish_hours,
    read_state,
    start_accumulation,
    start_hourly_snapshots,
)
from ..workspace import scratch_path
from . import views
from .views import table

QUERIES = {}
DELHI = (28.5562, 77.1)


def query(f):
    QUERIES[f.__name__] = f
    return f


def _site_table(spark: SparkSession) -> DataFrame:
    return dims.airports(spark, ref.LIVE_AIRPORT_CODES).select("code", "lat", "lon")


# --- sources and sinks -----------------------------------------------------------


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports spread over the year as partitioned parquet, read from March to August."""
    path = scratch_path(spark, "bronze")
    later = F.col("time") + F.col("event_id") % 300 * 86_400
    states = fn.with_date_parts(views.telemetry(spark, sf_dir).withColumn("time", later))
    write_partitioned(states, path, cluster=True)
    return files.read_layer(spark, path, since=(2024, 3), until=(2024, 8)).drop("event_id")


@query
def scan_states_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "states-csv")
    states = views.telemetry(spark, sf_dir).select(*schemas.names(schemas.STATES))
    (
        states.write.option("header", True)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .csv(path)
    )
    return files.read_states(spark, path)


@query
def scan_history_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names with outer spaces and inferred types."""
    path = scratch_path(spark, "history-csv")
    history = views.history(spark, sf_dir)
    (
        history.toDF(*[f" {c} " for c in history.columns])
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    read = files.read_csv_tree(spark, path, schema=None)
    return read.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "firstseen")})


@query
def scan_states_tar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives packed by tasks, those of one half with their columns in another order, and a damaged one."""
    path = scratch_path(spark, "archives")
    states = views.telemetry(spark, sf_dir)
    columns = schemas.names(schemas.STATES)
    for half, order in enumerate((columns, columns[::-1])):
        write_tar_csv(states.filter(F.col("event_id") % 2 == half).select(*order).repartition(3), f"{path}/half{half}")
    cut = files.list_files(spark, path, "*.tar").orderBy("path").select("path").first()[0]
    whole = spark.read.format("binaryFile").load(cut).select("content").first()[0]
    put(spark, f"{path}/damaged.tar", bytes(whole[: len(whole) // 2]))
    lines = files.read_tar_lines(spark, path)
    assert files.tar_errors(lines).count() == 1
    return files.tar_states(lines)


@query
def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source folder, from the path that every row carries."""
    path = scratch_path(spark, "days")
    write_partitioned(fn.with_date_parts(views.telemetry(spark, sf_dir)), path, by=("day",))
    rows = files.with_source_file(spark.read.parquet(path))
    day = F.regexp_extract("_source_file", r"/day=(\d+)/[^/]+\.parquet$", 1).cast("int")
    return rows.groupBy(day.alias("source_day")).agg(F.count(F.lit(1)).alias("rows"))


def _log_root(spark: SparkSession, sf_dir: str) -> str:
    """The log lines as one text file per task."""
    root = scratch_path(spark, "logs")
    keys = ["dag_id", "run_id", "task_id"]
    lines = views.log_lines(spark, sf_dir)
    lines.repartition(8, *keys).sortWithinPartitions(*keys, "place").select(*keys, "value").write.partitionBy(*keys).text(root)
    return root


@query
def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all logs changed since 2000, with the ids that their paths give."""
    root = _log_root(spark, sf_dir)
    assert read_logs(spark, root, "2999-01-01T00:00:00", "*.txt").isEmpty()
    return read_logs(spark, root, "2000-01-01T00:00:00", "*.txt").select("dag", "run", "task", "line")


@query
def task_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _log_root(spark, sf_dir)
    return ops_job(spark, root, {"logs": root}, pattern="*.txt")["tasks"]


@query
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five important lines of every log."""
    logs = read_logs(spark, _log_root(spark, sf_dir), pattern="*.txt")
    tail = log_summary(logs, lines_per_file=5)
    path = F.col("file")
    return tail.select(
        "dag", F.regexp_extract(path, "run_id=([^/]+)", 1).alias("run"), F.regexp_extract(path, "task_id=([^/]+)", 1).alias("task"),
        "important_lines", "from_end", "line",
    )


@query
def storage_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two stored layers, one file per day and four; and folders of the first."""
    days, parts = scratch_path(spark, "days"), scratch_path(spark, "parts")
    dated = fn.with_date_parts(views.telemetry(spark, sf_dir), parts=("day",))
    write_partitioned(dated.repartition(4, "day"), days, by=("day",))
    dated.repartition(4).write.parquet(parts)
    found = ops_job(spark, days, {"by_day": days, "in_parts": parts}, pattern="*.none")["storage"]
    found = found.select("layer", "files", (F.col("bytes") > 0).alias("has_bytes"))
    folders = folder_metrics(spark, days).agg(F.count(F.lit(1)).alias("files"))
    return found.unionByName(folders.select(F.lit("folders of by_day").alias("layer"), "files", F.lit(True).alias("has_bytes")))


@query
def job_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the layer jobs count while they write."""
    p = {n: scratch_path(spark, n) for n in ("history", "mapping", "raw", "bronze", "silver", "gold")}
    views.history(spark, sf_dir).select(*schemas.names(schemas.HISTORY)).write.option("header", True).csv(p["history"])
    states = views.telemetry(spark, sf_dir).select(*schemas.names(schemas.STATES))
    states.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(p["raw"])
    figures = {
        "mapping": mapping_job(spark, p["history"], p["mapping"]),
        "bronze": bronze_job(spark, p["raw"], p["bronze"], archives=False),
        "silver": silver_job(spark, p["bronze"], p["mapping"], p["silver"]),
        # there is no live layer yet
        "gold": gold_job(spark, p["silver"], scratch_path(spark, "none"), p["gold"]),
    }
    rows = [(job, name, float(n)) for job, found in figures.items() for name, n in found.items()]
    return dims.literal_rows(spark, rows, "job string, figure string, value double")


@query
def processing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = filters.with_processing_metadata(views.telemetry(spark, sf_dir))
    fresh = F.abs(F.unix_seconds("processing_time") - F.unix_seconds(F.current_timestamp())) < 3600
    return marked.groupBy("source", fresh.alias("is_fresh")).agg(F.count(F.lit(1)).alias("rows"))


@query
def bronze_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze job over CSV files: scan, region filter, partitioned append."""
    root, bronze = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    states = views.telemetry(spark, sf_dir).select(*schemas.names(schemas.STATES))
    states.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(root)
    bronze_job(spark, root, bronze, archives=False)
    return files.read_layer(spark, bronze).drop("batch")


@query
def bronze_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders loaded one after the other, then again: one by itself, one bounded by time, and both."""
    root, bronze = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    for half in (0, 1):
        states = views.telemetry(spark, sf_dir).filter(F.col("event_id") % 2 == half).select(*schemas.names(schemas.STATES))
        states.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/half{half}")
        bronze_job(spark, f"{root}/half{half}", bronze, archives=False)
    bronze_job(spark, f"{root}/half0", bronze, archives=False)
    bronze_job(spark, f"{root}/half1", bronze, archives=False, modified_after="2000-01-01T00:00:00")
    bronze_job(spark, root, bronze, archives=False)
    return files.read_layer(spark, bronze).drop("batch")


@query
def silver_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job: stored mapping, broadcast join, partitioned overwrite."""
    paths = {n: scratch_path(spark, n) for n in ("bronze", "mapping", "silver")}
    write_partitioned(fn.with_date_parts(views.telemetry(spark, sf_dir)), paths["bronze"])
    views.mapping(spark, sf_dir).write.parquet(paths["mapping"])
    silver_job(spark, paths["bronze"], paths["mapping"], paths["silver"])
    return files.read_layer(spark, paths["silver"])


@query
def new_files_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    listing = orders.select(
        F.col("o_orderkey").cast("string").alias("path"), F.col("o_custkey").alias("length")
    )
    ledger = orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("file_path")
    )
    return files.new_files(listing, ledger)


@query
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")

    def rows(df, layer):
        return df.groupBy(F.col("o_custkey").cast("string").alias("file_path")).agg(
            F.lit(layer).alias("layer"),
            F.max("o_orderkey").alias("file_size_bytes"),
            F.count(F.lit(1)).alias("record_count"),
        )

    done = F.col("o_orderstatus") == "F"
    return upsert_ledger(rows(orders.filter(done), "batch"), rows(orders.filter(~done), "speed"))


@query
def india_routes_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "region-routes")
    routes = filters.region_routes(views.mapping(spark, sf_dir))
    export_csv(routes, path, [F.desc("flight_count"), F.col("callsign")])
    return spark.read.schema(routes.schema).option("header", True).csv(path)


@query
def rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule with the number of reports it matches."""
    rules = dims.number_range_rules(spark)
    reports = lookup.with_callsign_parts(views.telemetry(spark, sf_dir))
    hits = lookup.enrich_by_rules(reports, rules, "all").groupBy("rule_rank").agg(
        F.count(F.lit(1)).alias("reports")
    )
    return rules.join(hits, "rule_rank", "left").withColumn(
        "reports", F.coalesce("reports", F.lit(0))
    )


@query
def route_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    airports = dims.airports(spark, ref.LIVE_AIRPORT_CODES)
    return lookup.route_schedule(
        views.schedule(spark, sf_dir), dims.schedule_carriers(spark), airports
    )


@query
def route_schedule_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    airports = dims.airports(spark, ref.LIVE_AIRPORT_CODES)
    return lookup.route_schedule(
        views.schedule(spark, sf_dir), dims.schedule_carriers(spark), airports, known_only=True
    ).select("callsign", "origin_code", "destination_code")


@query
def state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two positional reports per payload: one whole, one a slot short."""
    flights = views.live(spark, sf_dir)
    slots = [n for n in schemas.names(schemas.LIVE_STATES) if n != "ingestion_time"]
    whole = F.array(*[F.col(c).cast("string") for c in slots])
    payload = F.to_json(F.array(whole, F.slice(whole, 1, len(slots) - 1)))
    sent = flights.select("event_id", payload.alias("payload"))
    parsed = payloads.parse_state_vectors(sent, ingestion_time=F.lit("now"))
    return parsed.drop("sensors", "event_id")


@query
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    parsed = payloads.parse_json(messages, "k bigint")
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


# --- projections, filters, scalar functions -----------------------------------------


@query
def clean_callsign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.telemetry(spark, sf_dir).select(
        "event_id", fn.clean_code("callsign").alias("callsign_clean")
    )


@query
def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.telemetry(spark, sf_dir)
        .filter(fn.in_bbox("lat", "lon", ref.REGION_BOX))
        .select("event_id", "lat", "lon")
    )


@query
def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = fn.clean_code("callsign")
    return (
        views.telemetry(spark, sf_dir)
        .filter(fn.has_prefix(code, ref.REGION_PREFIXES))
        .select("event_id", code.alias("callsign_clean"))
    )


@query
def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_region(views.telemetry(spark, sf_dir))


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("year", "month", "day", "hour")
    return fn.with_date_parts(views.telemetry(spark, sf_dir), parts=parts).select(
        "event_id", *parts
    )


@query
def coalesce_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.history(spark, sf_dir).select(
        "o_orderkey",
        fn.first_of("estdepartureairport", "airportofdeparture").alias("dep_airport"),
        fn.first_of("estarrivalairport", "airportofdestination").alias("arr_airport"),
    )


@query
def valid_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.valid_history(views.history(spark, sf_dir)).select(
        "o_orderkey", "callsign_clean", "dep_airport", "arr_airport"
    )


@query
def region_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.region_routes(views.mapping(spark, sf_dir))


@query
def route_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.history(spark, sf_dir).select(
        "o_orderkey",
        fn.route_text("estdepartureairport", "estarrivalairport").alias("route"),
        F.concat_ws("-", "estdepartureairport", "estarrivalairport").alias("route_id"),
    )


@query
def airline_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedule = views.schedule(spark, sf_dir).withColumnRenamed("FlightNo", "flight_no")
    return lookup.schedule_carrier(schedule, dims.schedule_carriers(spark)).select(
        "flight_no", "airline_iata", "airline_name", "airline_prefix"
    )


@query
def flight_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat("callsign", F.lit("C3"))
    return views.telemetry(spark, sf_dir).select(
        "event_id",
        fn.flight_number(code).alias("first_run"),
        fn.all_digits(code).alias("all_digits"),
        fn.trailing_digits(code).alias("trailing"),
        fn.flight_number("icao24").alias("of_icao24"),
    )


@query
def make_callsign(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedule = views.schedule(spark, sf_dir).withColumnRenamed("FlightNo", "flight_no")
    coded = lookup.schedule_carrier(schedule, dims.schedule_carriers(spark))
    number = fn.trailing_digits("flight_no")
    return coded.select("flight_no", fn.make_callsign("airline_prefix", number).alias("callsign"))


@query
def airline_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.telemetry(spark, sf_dir).select(
        "event_id",
        fn.known_prefix(F.trim("callsign"), ref.LIVE_PREFIXES).alias("known_prefix"),
        fn.airline_prefix(F.trim("callsign")).alias("any_prefix"),
    )


@query
def airport_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = views.schedule(spark, sf_dir).select(
        F.col("FlightNo").alias("flight_no"),
        F.col("Origin").alias("origin_code"),
        F.col("Destination").alias("destination_code"),
    )
    return lookup.with_airport_attributes(routes, dims.airports(spark))


@query
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        "event_id", "airline_name", "airline_iata", "airline_icao", "airline_prefix",
        "origin_code", "origin_city", "destination_code", "destination_city",
    ]
    return filters.fill_unknown(views.speed(spark, sf_dir).select(*columns))


@query
def normalize_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.normalize_batch(views.silver(spark, sf_dir))


@query
def normalize_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.normalize_speed(views.speed_layer(spark, sf_dir))


@query
def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.telemetry_projection(views.silver(spark, sf_dir))


@query
def flight_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.with_flight_keys(views.telemetry(spark, sf_dir)).select(
        "event_id", fn.flight_id("flight_date", "callsign_clean").alias("flight_id")
    )


@query
def grid_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = star.with_grid(views.telemetry(spark, sf_dir))
    return cells.select(
        "event_id", "lat_bin", "lon_bin", fn.grid_key("lat_bin", "lon_bin").alias("geo_hash")
    )


@query
def flight_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = views.telemetry(spark, sf_dir).groupBy("icao24").agg(
        F.min("time").alias("first_seen"),
        F.max("time").alias("last_seen"),
        star.flagged("onground").alias("onground_count"),
        F.count(F.lit(1)).alias("total_data_points"),
    )
    return star.with_durations(flights)


@query
def hourly_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.telemetry(spark, sf_dir).select(
        "event_id",
        F.col("lastcontact").cast("bigint").alias("last_contact"),
        fn.utc_date("lastcontact").alias("date"),
        fn.utc_hour("lastcontact").alias("hour"),
    )


@query
def lookback_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.lookback(views.telemetry(spark, sf_dir), "time", ref.LOOKBACK_DAYS).select(
        "event_id", "time"
    )


@query
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = fn.haversine_km("lat", "lon", F.lit(DELHI[0]), F.lit(DELHI[1]))
    return views.telemetry(spark, sf_dir).select("event_id", F.round(km, 6).alias("km"))


@query
def bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    degrees = fn.bearing_deg("lat", "lon", F.lit(DELHI[0]), F.lit(DELHI[1]))
    return views.telemetry(spark, sf_dir).select("event_id", F.round(degrees, 6).alias("degrees"))


@query
def interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = fn.interpolate_position(
        "lat", "lon", F.lit(DELHI[0]), F.lit(DELHI[1]), F.col("heading") / 360
    )
    return views.telemetry(spark, sf_dir).select(
        "event_id", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon")
    )


# --- joins -----------------------------------------------------------------------------


@query
def enrich_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.enrich_routes(views.telemetry(spark, sf_dir), views.mapping(spark, sf_dir))


@query
def enrich_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with the published schedule, by exact call sign."""
    parts = lookup.with_callsign_parts(views.telemetry(spark, sf_dir))
    routes = route_schedule(spark, sf_dir).drop("flight_no", "airline_prefix")
    enriched = lookup.enrich_exact(parts, routes)
    return filters.with_both_ends(enriched)


def _ranged(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    reports = lookup.with_callsign_parts(views.telemetry(spark, sf_dir)).select(
        "event_id", "airline_prefix", "flight_number"
    )
    return lookup.enrich_by_rules(
        reports, dims.number_range_rules(spark), policy, keep_unmatched=False
    )


@query
def enrich_range_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranged(spark, sf_dir, "all")


@query
def enrich_range_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranged(spark, sf_dir, "first")


def _primary_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule as a route CSV gives it; the highest flight number of a call sign wins."""
    schedule = views.schedule(spark, sf_dir).withColumnRenamed("FlightNo", "flight_no")
    coded = lookup.schedule_carrier(schedule, dims.schedule_carriers(spark))
    code = fn.make_callsign("airline_prefix", fn.trailing_digits("flight_no"))
    rows = coded.select(
        F.concat(F.lower(code), F.lit(" ")).alias("callsign"),
        F.col("Origin").alias("origin"),
        F.col("Destination").alias("destination"),
        "flight_no",
    )
    return lookup.exact_route_table(rows, ["flight_no"])


@query
def enrich_callsign(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = views.telemetry(spark, sf_dir).select("event_id", "callsign")
    return lookup.enrich_callsign(reports, dims.airlines(spark), dims.number_range_rules(spark))


@query
def lookup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = views.telemetry(spark, sf_dir).select("event_id", "callsign")
    return lookup.lookup_exact(reports, _primary_routes(spark, sf_dir), dims.exact_routes(spark))


@query
def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = views.telemetry(spark, sf_dir).select("event_id", "lat", "lon")
    found = sites.nearest_site(positions, _site_table(spark), 500.0)
    return found.withColumn("site_km", F.round("site_km", 6))


@query
def nearest_site_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = views.telemetry(spark, sf_dir).select("event_id", "lat", "lon")
    return sites.nearest_site(positions, dims.airports(spark)).select("event_id", "site_code")


@query
def two_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = views.telemetry(spark, sf_dir).select(
        "event_id", "lat", "lon", "baroaltitude", "velocity"
    )
    return sites.two_nearest(positions, _site_table(spark)).select(
        "event_id", "first_site", "second_site"
    )


@query
def route_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = views.telemetry(spark, sf_dir).select(
        "event_id", "lat", "lon", "baroaltitude", "velocity", "onground"
    )
    return sites.route_from_position(positions, _site_table(spark)).select(
        "event_id", "origin_code", "destination_code", "confidence"
    )


@query
def enrich_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = views.live(spark, sf_dir).select(
        "event_id", "callsign", "latitude", "longitude", "baro_altitude", "geo_altitude",
        "on_ground",
    )
    return sites.enrich_hybrid(
        flights,
        _primary_routes(spark, sf_dir),
        dims.exact_routes(spark),
        dims.hybrid_airports(spark),
        dims.airlines(spark),
    )


@query
def track_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.track_endpoints(
        views.telemetry(spark, sf_dir), dims.airports(spark), radius_km=300.0
    )


@query
def infer_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes from tracks; altitudes are scaled down so that many tracks start and end low."""
    low = views.telemetry(spark, sf_dir).withColumn("baroaltitude", F.col("baroaltitude") / 20)
    return sites.infer_routes(low, dims.airports(spark), radius_km=800.0)


@query
def track_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fn.with_flight_keys(views.telemetry(spark, sf_dir))
    found = tracks.track_distance(days, ["icao24", "flight_date"])
    return found.withColumn("distance_km", F.round("distance_km", 6))


@query
def flight_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = fn.with_flight_keys(views.telemetry(spark, sf_dir))
    found = tracks.track_distance(flights, ["flight_date", "callsign_clean", "icao24"])
    return found.withColumn("distance_km", F.round("distance_km", 6))


# --- aggregates --------------------------------------------------------------------------


@query
def build_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.mapping(spark, sf_dir)


@query
def fact_flight_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_flight_history(views.silver(spark, sf_dir))


@query
def dim_route_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_route_analytics(fact_flight_history(spark, sf_dir))


@query
def dim_aircraft_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_aircraft_utilization(views.telemetry(spark, sf_dir))


@query
def dim_airspace_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_airspace_heatmap(views.telemetry(spark, sf_dir))


@query
def cell_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.cell_flights(views.telemetry(spark, sf_dir))


@query
def route_onground_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.route_onground_pct(views.silver(spark, sf_dir))


@query
def cruise_altitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.telemetry(spark, sf_dir).groupBy("icao24").agg(
        F.avg(star.cruise_altitude()).alias("avg_cruise_altitude"),
        star.flagged("onground").alias("onground_count"),
        star.flagged("alert").alias("alert_count"),
    )


@query
def match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.match_rate(views.silver(spark, sf_dir))


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_unified(views.silver(spark, sf_dir), views.speed_layer(spark, sf_dir))


@query
def flight_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.flight_summary(_unified(spark, sf_dir))


@query
def flight_summary_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary adapts to the columns of the raw batch layer."""
    return serving.flight_summary(views.telemetry(spark, sf_dir))


@query
def airline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.airline_stats(_unified(spark, sf_dir))


@query
def airport_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.airport_stats(_unified(spark, sf_dir))


@query
def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.hourly_stats(_unified(spark, sf_dir))


def _live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = views.speed(spark, sf_dir).drop("first_seen", "last_seen", "position_count")
    return live.accumulate(flights, "icao24", "last_contact", ("event_id",))


@query
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.accumulate(views.telemetry(spark, sf_dir), "icao24", "time", ("event_id",))


@query
def live_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_totals(_live_state(spark, sf_dir))


@query
def live_accumulator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.accumulator_totals(_live_state(spark, sf_dir))


@query
def live_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_by_country(_live_state(spark, sf_dir))


@query
def live_by_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_by_airline(_live_state(spark, sf_dir))


@query
def live_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_top_routes(_live_state(spark, sf_dir))


# --- unions, duplicates, samples -------------------------------------------------------------


@query
def merge_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir)


@query
def merge_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table as the star schema reads it."""
    gold = merge.merge_gold(views.silver(spark, sf_dir), views.speed_layer(spark, sf_dir))
    return gold.select(
        "data_source", *schemas.names(schemas.STATES), *lookup.ROUTE_COLUMNS, "origin_city"
    )


@query
def dedup_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all reports of one aircraft, call sign and contact hour the latest."""
    reports = views.telemetry(spark, sf_dir).select(
        "event_id", "icao24", fn.clean_code("callsign").alias("callsign"),
        F.floor(F.col("time") / 3600).alias("last_contact"), "time", "lat", "lon",
    )
    return merge.latest_per_key(reports, ref.STATE_KEY, ["time", "event_id"])


@query
def first_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first report of every aircraft and call sign."""
    reports = views.telemetry(spark, sf_dir).select(
        "event_id", "icao24", fn.clean_code("callsign").alias("callsign"), "time"
    )
    return merge.dedup(reports, ["icao24", "callsign"], ["time", "event_id"])


@query
def top_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three fastest reports of every aircraft."""
    reports = views.telemetry(spark, sf_dir).select("event_id", "icao24", "velocity")
    return merge.top_per_group(reports, ["icao24"], [F.desc("velocity"), "event_id"], 3)


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the reports."""
    return merge.sample_fraction(views.telemetry(spark, sf_dir), 0.5, ["event_id"])


@query
def sample_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the data: all reports of a quarter of the aircraft."""
    return merge.sample_fraction(views.telemetry(spark, sf_dir), 0.25, ["icao24"])


# --- streams ---------------------------------------------------------------------------------


def _as_stream(spark: SparkSession, df: DataFrame, label: str, files_per_batch: int | None = None):
    """The rows as a stream of files, in row groups that tasks can share: a file of one is read by one task."""
    path = scratch_path(spark, label)
    df.write.option("parquet.block.size", 4 << 20).parquet(path)
    reader = spark.readStream.schema(df.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _dealt(df: DataFrame, files: int) -> DataFrame:
    """The rows in so many parts by a hash of the whole row; dealt in turn, Spark sorts every task's rows first."""
    return df.repartition(files, F.xxhash64(*df.columns))


def _finish(stream_query) -> None:
    stream_query.awaitTermination()


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON reports through the enrichment stream into files, by number ranges."""
    messages = payloads.to_json_value(views.live(spark, sf_dir).drop("event_id", "sensors"))
    out = scratch_path(spark, "enriched")
    _finish(
        start_enrichment(
            _as_stream(spark, _dealt(messages, 8), "messages", 3),
            dims.route_rules(spark),
            "parquet",
            scratch_path(spark, "checkpoint"),
            available_now=True,
            sink_options={"path": out},
        )
    )
    enriched = payloads.parse_json(
        spark.read.schema("value string").parquet(out), schemas.SPEED_STATES
    )
    return enriched.drop("sensors", "first_seen", "last_seen", "position_count")


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed state over several micro-batches in arbitrary order."""
    out = scratch_path(spark, "state")
    _finish(
        start_accumulation(
            _as_stream(spark, _dealt(views.telemetry(spark, sf_dir), 8), "reports", 3),
            out,
            scratch_path(spark, "checkpoint"),
            ties=("event_id",),
            available_now=True,
        )
    )
    return read_state(spark, out)


@query
def stream_latest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed state whose batches are merged while the stream runs, between its two runs, and after."""
    source, out, checkpoint = (scratch_path(spark, n) for n in ("reports", "state", "checkpoint"))
    reports = views.telemetry(spark, sf_dir)
    for half in (0, 1):
        _dealt(reports.filter(F.col("event_id") % 2 == half), 6).write.mode("append").parquet(source)
        stream = spark.readStream.schema(reports.schema).option("maxFilesPerTrigger", 1).parquet(source)
        _finish(
            start_accumulation(
                stream, out, checkpoint, ties=("event_id",), available_now=True, merge_every=5
            )
        )
        merge_state(spark, out, fan=2, settled=half == 1)
    return read_state(spark, out)


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshots of a backlog in any order: eight files, one per micro-batch."""
    out = scratch_path(spark, "snapshots")
    reports = views.telemetry(spark, sf_dir)
    _finish(
        start_hourly_snapshots(
            _as_stream(spark, reports.repartition(8, F.xxhash64("event_id")), "reports", 1),
            out,
            scratch_path(spark, "checkpoint"),
            available_now=True,
            ties=("event_id",),
            publish=False,
        )
    )
    publish_hours(spark, out, ties=("event_id",), files_per_hour=1)
    return spark.read.parquet(out).drop(
        "year", "month", "day", "hour", "processing_time", "source"
    )


@query
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports and late reports per hour, of a stream that gets the odd reports after the even ones."""
    source, out, checkpoint = (scratch_path(spark, n) for n in ("reports", "snapshots", "checkpoint"))
    reports = views.telemetry(spark, sf_dir)
    for half in (0, 1):
        reports.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(reports.schema).parquet(source)
        _finish(
            start_hourly_snapshots(
                stream, out, checkpoint, available_now=True, ties=("event_id",), publish=False, late_after=600
            )
        )
    return late_reports(spark, out)


@query
def stream_hourly_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two micro-batches, each publishing the hours it touches."""
    out = scratch_path(spark, "snapshots")
    _finish(
        start_hourly_snapshots(
            _as_stream(spark, views.telemetry(spark, sf_dir).repartition(16, F.xxhash64("event_id")), "reports", 8),
            out,
            scratch_path(spark, "checkpoint"),
            available_now=True,
            ties=("event_id",),
            files_per_hour=1,
        )
    )
    return spark.read.parquet(out).drop(
        "year", "month", "day", "hour", "processing_time", "source"
    )


@query
def live_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live job over a stream of messages: rows of its three tables."""
    messages = payloads.to_json_value(views.live(spark, sf_dir).drop("event_id", "sensors"))
    p = {n: scratch_path(spark, n) for n in ("checkpoint", "enriched", "state", "hours")}
    started = live_job(
        _as_stream(spark, _dealt(messages, 4), "messages", 4), dims.route_rules(spark), p["checkpoint"],
        "parquet", {"path": p["enriched"]}, state_path=p["state"], snapshot_path=p["hours"], available_now=True,
    )
    for stream_query in started.values():
        _finish(stream_query)
    state, hours = read_state(spark, p["state"]), spark.read.parquet(p["hours"])
    enriched = spark.read.schema("value string").parquet(p["enriched"])
    counts = [
        enriched.select(F.lit("enrichment").alias("table"), F.lit(1).cast("long").alias("reports")),
        state.select(F.lit("state").alias("table"), F.col("position_count").alias("reports")),
        hours.select(F.lit("snapshots").alias("table"), F.col("position_count").alias("reports")),
    ]
    every = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return every.groupBy("table").agg(F.count(F.lit(1)).alias("rows"), F.sum("reports").alias("reports"))


@query
def stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier statistics merged from the partial rows of several batches.

    The mapping is stored first, as by its job, so that its bytes are known and no report is shuffled for it.
    """
    root, routes = scratch_path(spark, "serving"), scratch_path(spark, "mapping")
    views.mapping(spark, sf_dir).write.parquet(routes)
    silver = views.silver(spark, sf_dir, spark.read.parquet(routes))
    states = merge.merge_unified(silver, views.speed_layer(spark, sf_dir))
    _finish(
        start_serving(
            _as_stream(spark, _dealt(states, 8), "states", 3),
            root,
            scratch_path(spark, "checkpoint"),
        )
    )
    return serving_table(spark, root, serving.AIRLINE_STATS)


# --- jobs ------------------------------------------------------------------------------------


@query
def mapping_job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping job over CSV files whose columns are in another order."""
    root, out = scratch_path(spark, "history"), scratch_path(spark, "mapping")
    history = views.history(spark, sf_dir).select(*reversed(schemas.names(schemas.HISTORY)))
    (
        history.toDF(*[f" {c} " for c in history.columns])
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(root)
    )
    mapping_job(spark, root, out)
    return spark.read.parquet(out)


def _layers(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The silver and the live layer, stored."""
    paths = {n: scratch_path(spark, n) for n in ("silver", "speed", "gold", "once", "star", "serving")}
    write_partitioned(views.silver(spark, sf_dir).drop("event_id"), paths["silver"])
    hours = ("year", "month", "day", "hour")
    write_partitioned(views.speed_layer(spark, sf_dir).drop("event_id"), paths["speed"], by=hours, cluster=True)
    return paths


@query
def gold_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job in full and then incrementally, with and without copies, by month."""
    p = _layers(spark, sf_dir)
    out = None
    for name, target, distinct in (("full", "gold", False), ("distinct", "once", True)):
        for load in (name, "incremental" if name == "full" else f"{name} incremental"):
            gold_job(spark, p["silver"], p["speed"], p[target], full=load == name, distinct=distinct)
            rows = (
                spark.read.parquet(p[target])
                .groupBy("year", "month")
                .agg(F.count(F.lit(1)).alias("states"), F.sum("time").alias("seconds"))
                .withColumn("load", F.lit(load))
            )
            path = scratch_path(spark, "figures")  # the next load rewrites the layer's files
            rows.write.parquet(path)
            rows = spark.read.parquet(path)
            out = rows if out is None else out.unionByName(rows)
    return out


@query
def gold_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sixty days: a full load of the batch layer, and an increment when the live one came."""
    p = {n: scratch_path(spark, n) for n in ("silver", "speed", "gold")}
    later = F.col("time") + F.col("event_id") % 300 * 86_400
    silver = fn.with_date_parts(views.silver(spark, sf_dir).withColumn("time", later)).drop("event_id")
    write_partitioned(silver, p["silver"])
    gold_job(spark, p["silver"], p["speed"], p["gold"], days=60)
    moved = {c: F.col(c) + 330 * 86_400 for c in ("time_position", "last_contact")}
    live_rows = fn.with_date_parts(views.speed(spark, sf_dir).drop("event_id").withColumns(moved), "last_contact")
    write_partitioned(live_rows.withColumn("hour", fn.utc_hour("last_contact")), p["speed"], by=("year", "month", "day", "hour"))
    gold_job(spark, p["silver"], p["speed"], p["gold"], full=False, days=60)
    return spark.read.parquet(p["gold"]).groupBy("data_source", "year", "month").agg(
        F.count(F.lit(1)).alias("states"), F.sum("time").alias("seconds")
    )


@query
def star_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star job over the stored reports: rows and a control sum of two of its tables."""
    gold, star_path = scratch_path(spark, "gold"), scratch_path(spark, "star")
    write_partitioned(fn.with_date_parts(views.silver(spark, sf_dir)), gold)
    star_job(spark, gold, star_path)
    out = None
    for name, measure in (("fact_flight_history", "total_data_points"), ("raw_telemetry", "time")):
        rows = spark.read.parquet(f"{star_path}/{name}").agg(
            F.count(F.lit(1)).alias("n"), F.sum(measure).cast("bigint").alias("total")
        )
        rows = rows.withColumn("name", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def serving_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments, and the first again after new files came, under an id with colons."""
    p = {n: scratch_path(spark, n) for n in ("silver", "speed", "root")}
    silver = views.silver(spark, sf_dir).drop("event_id")
    early = F.col("day") <= 10
    hours = ("year", "month", "day", "hour")
    first = "manual__2026-01-04T15:12:49+00:00"
    write_partitioned(silver.filter(early), p["silver"])
    serving_job(spark, p["silver"], p["speed"], p["root"], first)
    write_partitioned(silver.filter(~early), p["silver"])
    write_partitioned(views.speed_layer(spark, sf_dir).drop("event_id"), p["speed"], by=hours, cluster=True)
    serving_job(spark, p["silver"], p["speed"], p["root"], "second")
    serving_job(spark, p["silver"], p["speed"], p["root"], first)
    ledger = spark.read.parquet(f"{p['root']}/ledger")
    unique = ledger.agg(F.count("file_path") == F.countDistinct("file_path")).first()[0]
    stats = serving_table(spark, p["root"], serving.AIRLINE_STATS)
    return stats.withColumns(
        {
            "stored_states": F.lit(stored_states(spark, p["root"]).count()).cast("bigint"),
            "ledger_unique": F.lit(unique),
        }
    )


def _two_loads(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A star table from a backlog of two loads whose reports alternate in time, the first one loaded twice."""
    gold, star_path = scratch_path(spark, "gold"), scratch_path(spark, "star")
    write_partitioned(views.silver(spark, sf_dir), gold)
    reports = spark.read.parquet(gold)
    first = F.col("event_id") % 3 == 0
    for batch, kept in (("2024-01-01", first), ("2024-01-02", ~first), ("2024-01-01", first)):
        star_load(spark, reports.filter(kept), star_path, batch, [table], refresh=False)
    refresh_star(spark, reports, star_path, [table])
    return read_star(spark, star_path, table)


@query
def star_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir, "fact_flight_history")


@query
def routes_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir, "dim_route_analytics")


@query
def aircraft_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir, "dim_aircraft_utilization")


@query
def heatmap_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir, "dim_airspace_heatmap")


@query
def telemetry_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir, "raw_telemetry")
