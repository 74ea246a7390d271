import random

import pytest
from pyspark.sql import functions as F

from trackloom.catalog import views
from trackloom.operators import live
from trackloom.operators.serving import AIRLINE_STATS
from trackloom.plans.live import live_job
from trackloom.plans.serving import serving_job
from trackloom.schemas import SPEED_STATES
from trackloom.sinks import write_stream
from trackloom.sources import dims, payloads
from trackloom.sources.streams import read_file_stream
from trackloom.streaming import enrich, state
from trackloom.streaming.serve import serving_table

DDL = "icao24 string, time bigint, n int, lat double"


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def reports(count=300, seed=1):
    rng = random.Random(seed)
    return [(f"a{rng.randrange(12)}", 1_704_067_200 + rng.randrange(20_000), i, rng.uniform(0, 9)) for i in range(count)]


@pytest.mark.parametrize("order", ["as_is", "reversed", "shuffled"])
def test_state_equals_table_in_any_order(spark, tmp_path, order):
    rows = reports()
    feed = {"as_is": rows, "reversed": rows[::-1], "shuffled": random.Random(5).sample(rows, len(rows))}[order]
    for i in range(0, 300, 60):
        spark.createDataFrame(feed[i:i + 60], DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_file_stream(spark, str(tmp_path / "in"), DDL, max_files_per_trigger=2)
    q = state.start_accumulation(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ties=("n",), available_now=True)
    q.awaitTermination()
    expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
    assert rows_of(state.read_state(spark, str(tmp_path / "out"))) == rows_of(expected)


def test_state_continues_after_restart(spark, tmp_path):
    rows = reports()
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):  # the second start finds nothing new
            stream = read_file_stream(spark, str(tmp_path / "in"), DDL)
            state.start_accumulation(
                stream, str(tmp_path / "out"), str(tmp_path / "cp"), ties=("n",), available_now=True
            ).awaitTermination()
    expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
    assert rows_of(state.read_state(spark, str(tmp_path / "out"))) == rows_of(expected)


def test_hourly_snapshots_take_every_report(spark, tmp_path):
    start = 1_704_067_200
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def feed(*rows):
        spark.createDataFrame(list(rows), DDL).coalesce(1).write.mode("append").parquet(source)
        stream = read_file_stream(spark, source, DDL)
        state.start_hourly_snapshots(stream, out, cp, available_now=True, ties=("n",)).awaitTermination()
        try:
            return sorted((r.icao24, r.time, r.position_count) for r in spark.read.schema(
                "icao24 string, time bigint, position_count bigint").parquet(out).collect())
        except Exception:
            return []

    first = feed(("a", start + 10, 1, 1.0), ("a", start + 5, 2, 1.0), ("b", start + 3599, 3, 1.0))
    assert first == [("a", start + 10, 2), ("b", start + 3599, 1)]
    # out of order: merged into its hour
    assert feed(("a", start + 3700, 4, 1.0), ("a", start + 20, 5, 1.0)) == [
        ("a", start + 20, 3), ("a", start + 3700, 1), ("b", start + 3599, 1)]
    later = feed(("d", start + 30 * 3600, 8, 1.0))
    # a day late, and still in its hour
    assert feed(("b", start + 7, 9, 1.0)) == sorted(
        [r for r in later if r[0] != "b"] + [("b", start + 3599, 2)])
    batch = state.hourly_snapshots(spark.createDataFrame([("a", start, 1, 1.0), ("a", start + 3600, 2, 1.0)], DDL))
    assert batch.count() == 2


def test_state_goes_on_after_compaction(spark, tmp_path):
    rows = reports()
    path = str(tmp_path / "out")
    for i in range(0, 300, 100):
        spark.createDataFrame(rows[i:i + 100], DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = read_file_stream(spark, str(tmp_path / "in"), DDL)
        state.start_accumulation(stream, path, str(tmp_path / "cp"), ties=("n",), available_now=True).awaitTermination()
        if i == 100:
            before, path = path, str(tmp_path / "compact")
            state.compact_state(spark, before, path)
            assert rows_of(state.read_state(spark, before)) == rows_of(state.read_state(spark, path))
    expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
    assert rows_of(state.read_state(spark, path)) == rows_of(expected)


def feed_state(spark, tmp_path, rows, **how):
    """One more file through the accumulation, and the rows so far."""
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_file_stream(spark, str(tmp_path / "in"), DDL)
    q = state.start_accumulation(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ties=("n",), available_now=True, **how)
    q.awaitTermination()


def test_state_is_merged_beside_the_stream(spark, tmp_path):
    rows = reports(600)
    path = str(tmp_path / "out")
    for i in range(24):
        feed_state(spark, tmp_path, rows[25 * i:25 * i + 25])
        state.merge_state(spark, path, fan=2)
        if i % 5 == 4:
            expected = live.accumulate(spark.createDataFrame(rows[:25 * i + 25], DDL), ties=("n",))
            assert rows_of(state.read_state(spark, path)) == rows_of(expected)
    kept = [*(tmp_path / "out/batches").glob("batch=*"), *(tmp_path / "out/levels").glob("generation=*")]
    assert len(kept) <= 2 * 5 + 4, kept  # twice the logarithm of the batches, and those that wait
    assert len([*(tmp_path / "out/manifest").glob("version=*")]) == 2
    expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
    some = state.read_state(spark, path, only=["a1", "a7", "none"])
    assert rows_of(some) == rows_of(expected.filter("icao24 in ('a1', 'a7')"))


def test_stream_merges_its_own_batches(spark, tmp_path):
    rows = reports()
    for i in range(0, 300, 30):
        feed_state(spark, tmp_path, rows[i:i + 30], merge_every=4)
    assert [*(tmp_path / "out/levels").glob("generation=*")]
    expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
    assert rows_of(state.read_state(spark, str(tmp_path / "out"))) == rows_of(expected)


def test_lost_merge_is_done_again(spark, tmp_path):
    """A generation that was written without its manifest version counts for nothing."""
    rows = reports()
    for i in range(0, 300, 60):
        feed_state(spark, tmp_path, rows[i:i + 60])
    path = str(tmp_path / "out")
    spark.createDataFrame([("a1", 1)], "icao24 string, time long").write.parquet(f"{path}/levels/generation=00000001")
    expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
    assert rows_of(state.read_state(spark, path)) == rows_of(expected)
    assert state.merge_state(spark, path) and not state.merge_state(spark, path)
    assert rows_of(state.read_state(spark, path)) == rows_of(expected)


def test_batch_without_changes_leaves_no_folder(spark, tmp_path):
    none = spark.createDataFrame([], DDL)
    state.upsert_state(none, str(tmp_path / "out"), 3)
    assert not (tmp_path / "out/batches/batch=3").exists()
    with pytest.raises(FileNotFoundError):
        state.read_state(spark, str(tmp_path / "out"))


HOUR = 1_704_067_200


def snapshots(*rows):
    return [(o, HOUR + t, n, 1.0) for o, t, n in rows]


def published(spark, out):
    layout = "icao24 string, time bigint, first_seen bigint, position_count bigint"
    return sorted((r.icao24, r.time - HOUR, r.first_seen - HOUR, r.position_count) for r in spark.read.schema(layout).parquet(out).collect())


def test_a_batch_reads_only_its_hours(spark, tmp_path):
    out = str(tmp_path / "hours")

    def publish(batch, *rows):
        state.store_hours(spark.createDataFrame(snapshots(*rows), DDL), out, batch, ties=("n",))
        return state.publish_hours(spark, out, ties=("n",), files_per_hour=1)

    assert publish(0, ("a", 5, 1), ("a", 4000, 2)) == [HOUR, HOUR + 3600]
    assert publish(1, ("b", 9000, 3)) == [HOUR + 7200]
    late = spark.createDataFrame(snapshots(("a", 3700, 4), ("c", 3800, 5)), DDL)
    state.store_hours(late, out, 2, ties=("n",))
    files = state.hour_input(spark, out, {HOUR + 3600: 0}).inputFiles()
    assert files and all(f"hour_start={HOUR + 3600}/" in f or "/_parts/batch=2/" in f for f in files)
    folders = (tmp_path / "hours").glob("year=*/month=*/day=*/hour=*/*.parquet")
    untouched = {p: p.stat().st_mtime_ns for p in folders if "hour=01" not in str(p)}
    assert state.publish_hours(spark, out, ties=("n",), files_per_hour=1) == [HOUR + 3600]
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())
    assert published(spark, out) == [("a", 5, 5, 1), ("a", 4000, 3700, 2), ("b", 9000, 9000, 1), ("c", 3800, 3800, 1)]
    assert not [*(tmp_path / "hours/_parts").glob("batch=*")]  # merged parts are dropped
    assert len([*(tmp_path / "hours/_merged").glob("hour_start=*/upto=*")]) == 3
    assert state.publish_hours(spark, out, ties=("n",)) == []


@pytest.mark.parametrize("lost", ["before the drop", "before the publication"])
def test_lost_publication_goes_on(spark, tmp_path, monkeypatch, lost):
    out = str(tmp_path / "hours")
    frame = spark.createDataFrame(snapshots(("a", 5, 1), ("a", 9, 2), ("b", 7, 3)), DDL)
    state.store_hours(frame, out, 0, ties=("n",))
    state.publish_hours(spark, out, ties=("n",))

    def stop(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        state.store_hours(frame, out, 1, ties=("n",))
        m.setattr(state, "remove" if lost == "before the drop" else "with_hour_partitions", stop)
        with pytest.raises(RuntimeError):
            state.publish_hours(spark, out, ties=("n",))
    for _ in range(2):  # the batch again, as the stream repeats it, and once more
        state.store_hours(frame, out, 1, ties=("n",))
        state.publish_hours(spark, out, ties=("n",))
        assert published(spark, out) == [("a", 9, 5, 4), ("b", 7, 7, 2)]


def messages(spark, sf_dir):
    return payloads.to_json_value(views.live(spark, sf_dir).drop("event_id"))


@pytest.mark.parametrize("mode", ["rules", "schedule"])
def test_stream_enrichment_equals_table(spark, sf_dir, tmp_path, mode):
    from trackloom.catalog.queries import QUERIES

    routes = dims.route_rules(spark) if mode == "rules" else QUERIES["route_schedule"](spark, sf_dir).drop(
        "flight_no", "airline_prefix")
    junk = spark.createDataFrame([("{bad",), (None,), ("[]",)], "value string")
    sent = messages(spark, sf_dir)
    sent.unionByName(junk).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = read_file_stream(spark, str(tmp_path / "in"), "value string", max_files_per_trigger=1)
    enrich.start_enrichment(
        stream, routes, "parquet", str(tmp_path / "cp"), available_now=True,
        sink_options={"path": str(tmp_path / "out")},
    ).awaitTermination()
    got = payloads.parse_json(spark.read.parquet(str(tmp_path / "out")), SPEED_STATES)
    flights = payloads.parse_json(sent)
    expected = enrich.enrich_flights(flights, routes)
    assert expected.count() > 0
    columns = expected.columns
    assert rows_of(got.select(columns)) == rows_of(expected)


def test_enrichment_keyed_and_filled(spark, sf_dir):
    routes = dims.route_rules(spark)
    sent = messages(spark, sf_dir)
    out = enrich.enrich_stream(sent, routes, key="icao24", keep_unmatched=True, fill=True)
    assert out.columns == ["key", "value"] and out.count() == sent.count()
    rows = payloads.parse_json(out, SPEED_STATES)
    assert rows.filter("origin_code is null or airline_name is null").count() == 0
    assert rows.filter("origin_code = 'UNK'").count() > 0


def test_live_job_runs_all_three(spark, sf_dir, tmp_path):
    messages(spark, sf_dir).repartition(2).write.parquet(str(tmp_path / "in"))
    queries = live_job(
        read_file_stream(spark, str(tmp_path / "in"), "value string"),
        dims.route_rules(spark),
        str(tmp_path / "cp"),
        "parquet",
        {"path": str(tmp_path / "out")},
        state_path=str(tmp_path / "state"),
        snapshot_path=str(tmp_path / "hours"),
        available_now=True,
    )
    assert set(queries) == {"enrichment", "state", "snapshots"}
    for q in queries.values():
        q.awaitTermination()
        assert q.exception() is None
    flights = payloads.parse_json(messages(spark, sf_dir))
    matched = enrich.enrich_flights(flights, dims.route_rules(spark))
    assert spark.read.parquet(str(tmp_path / "out")).count() == matched.count()
    kept = state.read_state(spark, str(tmp_path / "state"))
    assert kept.agg(F.sum("position_count")).first()[0] == matched.count()
    hours = spark.read.parquet(str(tmp_path / "hours"))
    assert hours.count() > 0 and hours.first().source == "speed_layer"
    # the snapshots are the live layer that the serving load reads
    loaded = serving_job(spark, str(tmp_path / "none"), str(tmp_path / "hours"), str(tmp_path / "serving"), "r1")
    assert loaded["states"] == hours.count()
    airlines = serving_table(spark, str(tmp_path / "serving"), AIRLINE_STATS)
    assert airlines.agg(F.sum("total_flights")).first()[0] == hours.filter("airline_name is not null").count()


def test_trigger_by_interval(spark, tmp_path):
    spark.createDataFrame(reports(), DDL).write.parquet(str(tmp_path / "in"))
    q = write_stream(
        read_file_stream(spark, str(tmp_path / "in"), DDL), "memory", str(tmp_path / "cp"),
        every="1 second", queryName="interval_test",
    )
    q.processAllAvailable()
    q.stop()
    assert spark.table("interval_test").count() == 300


def test_rocksdb_state_store(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    state.use_rocksdb(spark)
    try:
        rows = reports(100)
        spark.createDataFrame(rows, DDL).write.parquet(str(tmp_path / "in"))
        state.start_accumulation(
            read_file_stream(spark, str(tmp_path / "in"), DDL), str(tmp_path / "out"),
            str(tmp_path / "cp"), ties=("n",), available_now=True,
        ).awaitTermination()
        expected = live.accumulate(spark.createDataFrame(rows, DDL), ties=("n",))
        assert rows_of(state.read_state(spark, str(tmp_path / "out"))) == rows_of(expected)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_serving_stream_takes_only_new_files(spark, sf_dir, tmp_path):
    from trackloom.operators import serving
    from trackloom.operators.merge import normalize_speed
    from trackloom.streaming.serve import start_serving, stored_states

    layer = views.speed_layer(spark, sf_dir).drop("event_id")
    root = str(tmp_path / "root")
    ddl = ", ".join(f"`{n}` {t}" for n, t in layer.dtypes)
    early = F.col("day") <= 15
    for part in (layer.filter(early), layer.filter(~early)):
        part.coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):
            start_serving(
                read_file_stream(spark, str(tmp_path / "in"), ddl, max_files_per_trigger=1),
                root, str(tmp_path / "cp"), normalize_speed,
            ).awaitTermination()
    assert stored_states(spark, root).count() == layer.count()
    for table in serving.SERVING_TABLES:
        direct = table.build(normalize_speed(layer))
        exact = [c for c in direct.columns if not c.startswith("avg")]
        assert rows_of(serving_table(spark, root, table).select(exact)) == rows_of(direct.select(exact))


def test_late_reports_are_counted_by_hour(spark, tmp_path):
    path, hour = str(tmp_path), 3600
    batches = [
        [("a", 5 * hour, 1, 1.0), ("b", 5 * hour + 9, 2, 1.0)],
        [("a", 5 * hour - 1, 3, 1.0), ("a", 4 * hour, 4, 1.0), ("a", 6 * hour, 5, 1.0), (None, 1, 6, 1.0)],
        [],
        [("c", 6 * hour - 601, 7, 1.0), ("c", 6 * hour - 600, 8, 1.0), ("c", 9, 9, 1.0)],
    ]
    assert state.late_reports(spark, path).count() == 0
    for n, rows in enumerate(batches):
        for _ in range(2):  # a repeated batch counts once
            state.store_hours(spark.createDataFrame(rows, DDL), path, n, ties=("n",), late_after=600)
    got = {tuple(r) for r in state.late_reports(spark, path).select("hour_start", "reports", "late").collect()}
    assert got == {(5 * hour, 4, 1), (4 * hour, 2, 1), (6 * hour, 1, 0), (0, 1, 1)}
    assert len(list((tmp_path / "_late").iterdir())) == 2
    state.publish_hours(spark, path, ties=("n",), files_per_hour=1)
    kept = spark.read.parquet(path)
    assert "late_count" not in kept.columns and kept.agg({"position_count": "sum"}).first()[0] == 8


def test_versions_of_many_hours_take_one_listing(spark, tmp_path, monkeypatch):
    for hour, upto in ((0, 3), (0, 12), (3600, 12), (7200, 5), (-3600, 1)):
        (tmp_path / "_merged" / f"hour_start={hour}" / f"upto={upto}").mkdir(parents=True)
    calls, listed = [], state.folders
    monkeypatch.setattr(state, "folders", lambda *a: calls.append(a) or listed(*a))
    assert state._versions(spark, str(tmp_path), [0, 3600, -3600, 9000]) == {0: [-1, 3, 12], 3600: [-1, 12], -3600: [-1, 1], 9000: [-1]}
    assert len(calls) == 1


def test_a_dropped_report_is_looked_up_once(spark):
    """A filter on both ends of a route would otherwise repeat the search for the rule."""
    from test_plans import plan

    from trackloom.operators import filters, lookup
    from trackloom.sources import dims

    rows = spark.createDataFrame([("IGO", 101), ("ZZZ", 5), (None, None)], "airline_prefix string, flight_number int").repartition(2)
    index = lookup.rule_index(dims.route_rules(spark))
    known = filters.with_both_ends(lookup.enrich_by_rules(rows, index, keep_unmatched=False))
    assert plan(known).count("aggregate(") == plan(lookup.enrich_by_rules(rows, index)).count("aggregate(")
