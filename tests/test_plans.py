"""Plans that the operators must have, whatever the size of the data."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from trackloom.catalog import views
from trackloom.catalog.queries import QUERIES
from trackloom.operators import filters, live, lookup, sites, star, tracks
from trackloom.operators.merge import merge_unified
from trackloom.sources import dims, files

STREAMS_AND_FILES = {n for n in QUERIES if n.startswith(("scan_", "stream_", "bronze_", "silver_"))} | {
    "india_routes_export"
}


def plan(df, spark=None):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS_AND_FILES))
def test_no_query_runs_python_per_row_or_crosses_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_route_join_is_broadcast_by_the_planner_only(spark, sf_dir, tmp_path):
    views.mapping(spark, sf_dir).write.parquet(str(tmp_path / "m"))
    mapping = spark.read.parquet(str(tmp_path / "m"))
    states = views.telemetry(spark, sf_dir)
    assert "BroadcastHashJoin" in plan(lookup.enrich_routes(states, mapping))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = plan(lookup.enrich_routes(states, mapping))
        assert "BroadcastHashJoin" not in beyond and "SortMergeJoin" in beyond
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_both_ways_of_the_route_join_agree(spark, sf_dir):
    states, mapping = views.telemetry(spark, sf_dir), views.mapping(spark, sf_dir)
    small = lookup.enrich_routes(states, mapping)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup.enrich_routes(states, mapping)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reports_are_not_shuffled_by_their_few_prefixes(spark, sf_dir):
    reports = lookup.with_callsign_parts(views.telemetry(spark, sf_dir))
    text = plan(lookup.enrich_by_rules(reports, dims.route_rules(spark)))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_position_lookup_keeps_one_row_per_position(spark, sf_dir):
    positions = views.telemetry(spark, sf_dir)
    text = plan(sites.nearest_site(positions, dims.airports(spark), 500.0))
    assert "BroadcastHashJoin LeftOuter" in text and "Window" not in text


def heavy_aggregates(text):
    """Aggregates directly above the scan side, before the first shuffle."""
    return re.findall(r"\n\((\d+)\) (\w*Aggregate)", text)


@pytest.mark.parametrize("build", [
    lambda g: star.fact_flight_history(g),
    lambda g: star.dim_airspace_heatmap(g),
])
def test_first_aggregate_of_the_star_is_a_hash_aggregate(spark, sf_dir, tmp_path, build):
    path = str(tmp_path / "gold")
    views.silver(spark, sf_dir).write.parquet(path)
    kinds = [kind for _, kind in heavy_aggregates(plan(build(spark.read.parquet(path))))]
    assert kinds[0] == "HashAggregate" and kinds[1] == "HashAggregate"


@pytest.mark.parametrize("build", [
    lambda t, s: sites.track_endpoints(t, dims.airports(s)),
    lambda t, s: star.dim_aircraft_utilization(t),
])
def test_first_and_last_reports_are_reduced_before_the_shuffle(spark, sf_dir, build):
    """Whole reports are minima and maxima of structs, with a partial step; no window over a track."""
    text = plan(build(views.telemetry(spark, sf_dir), spark))
    assert "Window" not in text and len(heavy_aggregates(text)) >= 2
    first = int(heavy_aggregates(text)[0][0])
    assert all(int(n) > first for n in re.findall(r"\n\((\d+)\) Exchange", text))


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(star.dim_airspace_heatmap(views.telemetry(spark, sf_dir)))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "props" not in schema and "event_type" not in schema


def test_box_filter_is_pushed_to_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "bronze")
    views.telemetry(spark, sf_dir).write.parquet(path)
    box = spark.read.parquet(path).filter(F.col("lat").between(6.0, 37.0))
    assert "GreaterThanOrEqual(lat,6.0)" in plan(box)
    region = plan(filters.filter_region(spark.read.parquet(path)).select("icao24"))
    assert "heading" not in re.search(r"ReadSchema: (.*)", region).group(1)


def test_distance_shuffles_reports_once_by_track_and_bucket(spark, sf_dir):
    text = plan(tracks.track_distance(views.telemetry(spark, sf_dir)))
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert len(exchanges) == 2 and "_bucket" in exchanges[0]


def test_state_is_reduced_before_the_shuffle(spark, sf_dir):
    text = plan(live.accumulate(views.telemetry(spark, sf_dir)))
    assert text.count("Exchange") >= 1 and len(heavy_aggregates(text)) == 2


def test_log_tail_is_cut_before_the_shuffle(spark, tmp_path):
    from trackloom.operators.ops import log_summary
    from trackloom.sources.logs import read_logs

    (tmp_path / "x.log").write_text("error\n" * 10)
    assert plan(log_summary(read_logs(spark, str(tmp_path)), 5, 2)).count("WindowGroupLimit") >= 2


def test_top_rows_are_cut_before_the_shuffle(spark, sf_dir):
    assert plan(QUERIES["top_reports"](spark, sf_dir)).count("WindowGroupLimit") >= 2


def test_fixed_tables_have_a_known_size(spark):
    for table in (dims.airports(spark), dims.airlines(spark), dims.route_rules(spark),
                  dims.exact_routes(spark), dims.schedule_carriers(spark)):
        assert "LocalTableScan" in plan(table)


def test_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "a.bin").write_text("x")
    text = plan(files.list_files(spark, str(tmp_path)))
    assert "content" not in re.search(r"ReadSchema: (.*)", text).group(1)


class _Reached(Exception):
    pass


def stream_source(monkeypatch, spark, sf_dir, name):
    """The rows that a query stores as the files of its stream."""
    seen = []

    def reach(_, df, *__):
        seen.append(df)
        raise _Reached

    monkeypatch.setattr("trackloom.catalog.queries._as_stream", reach)
    with pytest.raises(_Reached):
        QUERIES[name](spark, sf_dir)
    return seen[0]


@pytest.mark.parametrize("name", ["stream_enrich", "stream_latest", "live_tables", "stream_serving"])
def test_stream_files_are_dealt_without_a_sort(monkeypatch, spark, sf_dir, name):
    text = plan(stream_source(monkeypatch, spark, sf_dir, name))
    assert "RoundRobinPartitioning" not in text and "xxhash64" in text


def test_serving_stream_shuffles_no_report_for_its_route(monkeypatch, spark, sf_dir):
    # a bound between the bytes of the mapping and those of the history that it comes from
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        source = stream_source(monkeypatch, spark, sf_dir, "stream_serving")
        text = plan(source)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 2
    # every state, with what the unified layout of the whole query has, in files of much the same size
    whole = merge_unified(views.silver(spark, sf_dir), views.speed_layer(spark, sf_dir))
    assert source.exceptAll(whole).count() == 0 and whole.exceptAll(source).count() == 0
    sizes = [r[0] for r in source.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * min(sizes)
