import contextlib
import gzip
import io
import re
import tarfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trackloom import schemas, sinks
from trackloom.sources import files, jdbc, logs, payloads, streams
from trackloom.workspace import scratch_path, shared_root

HEADER = ",".join(schemas.names(schemas.STATES))


def line(time, callsign, lat=10.0):
    return f"{time},abc,{lat},70.0,1.5,2,,{callsign},False,,true,0012,100.0,,5.0,6.0"


def add_tar(path, members, cut=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w") as tar:
        for name, text in members:
            data = gzip.compress(text.encode()) if name.endswith(".gz") else text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    if cut:
        path.write_bytes(path.read_bytes()[:cut])


@pytest.fixture
def tar_root(tmp_path):
    many = "\n".join([HEADER, *[line(i, "IGO1  ") for i in range(5000)]])
    add_tar(tmp_path / "2024/01/a.tar", [("x.txt", "no"), ("a.csv.gz", f"{HEADER}\r\n{line(1, 'AIC1')}\r\n"), ("b.csv.gz", f"{HEADER}\n{line(9, 'NO')}")])
    add_tar(tmp_path / "2024/02/b.tar", [("b.csv.gz", many)])
    add_tar(tmp_path / "c.tar", [])
    add_tar(tmp_path / "d.tar", [("readme.txt", "nothing")])
    add_tar(tmp_path / "e.tar", [("e.csv.gz", many)], cut=900)
    (tmp_path / "f.tar").write_bytes(b"not an archive at all" * 100)
    (tmp_path / "g.csv").write_text("ignored")
    return str(tmp_path)


def test_tar_archives(spark, tar_root):
    lines = files.read_tar_lines(spark, tar_root)
    states = files.tar_states(lines)
    assert states.columns == schemas.names(schemas.STATES)
    assert states.groupBy("callsign").count().orderBy("callsign").collect() == [("AIC1", 1), ("IGO1  ", 5000)]
    first = states.filter("callsign = 'AIC1'").first()
    assert (first.time, first.vertrate, first.onground, first.alert, first.spi) == (1, None, False, None, True)
    assert (first.squawk, first.geoaltitude, first.lastcontact) == ("0012", None, 6.0)
    broken = {r.tar_path.rsplit("/", 1)[1] for r in files.tar_errors(lines).collect()}
    assert broken == {"e.tar", "f.tar"}


def test_tars_by_time_of_change(spark, tar_root):
    assert files.read_tar_csv(spark, tar_root, modifiedAfter="2000-01-01T00:00:00").count() == 5001
    assert files.read_tar_csv(spark, tar_root, modifiedBefore="2000-01-01T00:00:00").count() == 0


def test_damaged_member_of_a_whole_tar_gives_no_rows(spark, tmp_path):
    text = "\n".join([HEADER] + [line(i, f"IGO{i % 97}") for i in range(50_000)])
    packed = gzip.compress(text.encode())
    half = packed[: len(packed) // 2]
    with tarfile.open(tmp_path / "x.tar", "w") as tar:
        info = tarfile.TarInfo("x.csv.gz")
        info.size = len(half)
        tar.addfile(info, io.BytesIO(half))
    lines = files.read_tar_lines(spark, str(tmp_path))
    assert files.tar_states(lines).count() == 0
    assert [r.tar_path.rsplit("/", 1)[1] for r in files.tar_errors(lines).collect()] == ["x.tar"]


def test_history_columns_in_any_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text(" typecode ,callsign,extra,firstseen\nT,igo1 ,e,7\n")
    row = files.read_csv_tree(spark, str(tmp_path)).first()
    assert (row.callsign.strip(), row.typecode, row.firstseen, row.extra, row.model) == ("igo1", "T", 7, "e", None)
    (tmp_path / "b.csv").write_text("callsign,typecode,extra,firstseen\nigo2,T,e,7\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv_tree(spark, str(tmp_path)).collect()
    (tmp_path / "s").mkdir()
    (tmp_path / "s/s.csv").write_text("icao24,time\nx,1\n")
    with pytest.raises(Exception, match="header"):
        files.read_states(spark, str(tmp_path / "s")).collect()


def test_csv_reader_agrees_with_tar_reader(spark, tar_root, tmp_path):
    path = tmp_path / "one.csv.gz"
    path.write_bytes(gzip.compress(f"{HEADER}\n{line(1, 'AIC1')}\n".encode()))
    a = files.read_states(spark, str(path)).collect()
    b = files.read_tar_csv(spark, tar_root).filter("callsign = 'AIC1'").collect()
    assert a == b


def test_history_tree(spark, tmp_path):
    (tmp_path / "x/y").mkdir(parents=True)
    (tmp_path / "x/y/a.csv").write_text("callsign, model ,n\nIGO1,A320,1\n")
    (tmp_path / "x/b.csv.gz").write_bytes(gzip.compress(b"callsign, model ,n\nIGO2,,2\n"))
    (tmp_path / "c.txt").write_text("callsign, model ,n\nNO,,3\n")
    df = files.read_csv_tree(spark, str(tmp_path), schema=None)
    assert df.columns == ["callsign", "model", "n"]
    assert sorted(r.n for r in df.collect()) == [1, 2]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        files.read_csv_tree(spark, str(tmp_path / "empty"))


def test_optional_layer(spark, tmp_path):
    assert files.read_optional(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/x.parquet").write_text("this is not parquet")
    with pytest.raises(Exception) as problem:
        files.read_optional(spark, str(tmp_path / "bad")).count()
    assert not (isinstance(problem.value, AnalysisException) and problem.value.getCondition() == "PATH_NOT_FOUND")


def test_layer_bounds_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = [(y, m, 1) for y in (2023, 2024) for m in (1, 6, 12)]
    df = spark.createDataFrame(rows, "year int, month int, v int")
    sinks.write_partitioned(df, path)
    got = files.read_layer(spark, path, since=(2023, 6), until=(2024, 1))
    assert sorted((r.year, r.month) for r in got.collect()) == [(2023, 6), (2023, 12), (2024, 1)]
    assert len(got.inputFiles()) == 6  # the listing; pruning happens in the scan
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain("formatted")
    filters = re.search(r"PartitionFilters: (.*)", out.getvalue()).group(1)
    assert "year" in filters and "month" in filters


def test_new_files_and_ledger(spark, tmp_path):
    root, ledger_path = str(tmp_path / "my data+x"), str(tmp_path / "ledger")
    df = spark.range(10).withColumns({"year": F.lit(2024), "month": F.lit(1)})
    sinks.write_partitioned(df, root)
    assert sinks.read_ledger(spark, ledger_path) is None
    rows, listing = files.read_new_files(spark, root)
    counts = rows.groupBy(F.col("_source_file").alias("file_path")).agg(F.count("*").alias("record_count"))
    sinks.append_ledger(sinks.ledger_rows(listing, "batch", counts), ledger_path, "r1")
    sinks.append_ledger(sinks.ledger_rows(listing, "batch", counts), ledger_path, "r1")
    ledger = sinks.read_ledger(spark, ledger_path)
    assert ledger.count() == listing.count() and ledger.agg(F.sum("record_count")).first()[0] == 10
    assert files.read_new_files(spark, root, ledger)[0] is None
    sinks.write_partitioned(df.withColumn("month", F.lit(2)).limit(3), root)
    rows, listing = files.read_new_files(spark, root, ledger)
    assert rows.count() == 3 and {"year", "month"} <= set(rows.columns)
    assert rows.select("month").distinct().collect() == [(2,)]


def test_ledger_upsert_replaces(spark):
    ddl = "file_path string, layer string, record_count int"
    old = spark.createDataFrame([("a", "batch", 9), ("b", "batch", 2)], ddl)
    new = spark.createDataFrame([("a", "batch", 1), ("c", "speed", 3)], ddl)
    got = sorted(map(tuple, sinks.upsert_ledger(old, new).collect()))
    assert got == [("a", "batch", 1), ("b", "batch", 2), ("c", "speed", 3)]


def test_partition_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2024, 1, 1), (2024, 2, 2)], "year int, month int, v int")
    sinks.write_partitioned(df, path, cluster=True)
    sinks.write_partitioned(df.filter("month = 2").withColumn("v", F.lit(7)), path, "overwrite_partitions")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 7]


def test_hourly_folders_are_zero_padded(spark, tmp_path):
    path = tmp_path / "hours"
    sinks.write_hourly(spark.createDataFrame([(1_704_099_600, 1)], "time bigint, v int"), str(path))
    assert (path / "year=2024/month=01/day=01/hour=09").is_dir()


def test_export_in_order(spark, tmp_path):
    df = spark.range(1000).repartition(7)
    sinks.export_csv(df, str(tmp_path / "one"), [F.desc("id")], single_file=True)
    parts = sorted((tmp_path / "one").glob("part-*"))
    text = [p.read_text().split() for p in parts]
    assert len(parts) == 1 and text[0][:3] == ["id", "999", "998"]
    sinks.export_csv(df, str(tmp_path / "many"), [F.desc("id")])
    rows = [x for p in sorted((tmp_path / "many").glob("part-*")) for x in p.read_text().split()[1:]]
    assert rows == [str(i) for i in range(999, -1, -1)]


def test_state_vectors(spark):
    whole = '["a", "IGO1 ", "India", 1, 2, 77.5, 28.5, null, true, 10, 5.5, -1, [1, 2], 3.0, "0012", false, 0]'
    short = '["b", "IGO2", "India", 1, 2, 77.5, 28.5, null, true, 10, 5.5, -1, null, 3.0, "0012", false]'
    df = spark.createDataFrame([(f"[{whole}, {short}]",), ("{bad",), ("[]",)], "payload string")
    got = payloads.parse_state_vectors(df).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.icao24, row.callsign, row.time_position, row.baro_altitude) == ("a", "IGO1 ", 1, None)
    assert (row.on_ground, row.longitude, row.sensors, row.position_source) == (True, 77.5, "[1,2]", 0)
    assert row.ingestion_time


def test_json_round_trip_and_malformed(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "icao24 string, last_contact bigint")
    sent = payloads.to_json_value(df, "icao24")
    assert sent.columns == ["key", "value"]
    binary = sent.select(F.col("value").cast("binary").alias("value")).unionByName(
        spark.createDataFrame([(b"{bad",)], "value binary")
    )
    got = payloads.parse_json(binary, "icao24 string, last_contact bigint")
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1), ("b", None), (None, None)]


def test_log_lines_keep_file_order(spark, tmp_path):
    folder = tmp_path / "dag_id=d1" / "run_id=manual__2024-01-01T00:00:00+00:00" / "task_id=t1"
    folder.mkdir(parents=True)
    text = [f"line {i}" for i in range(2000)]
    (folder / "attempt=1.log").write_text("\n".join(text))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = logs.read_logs(spark, str(tmp_path)).orderBy("block", "line_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.line for r in rows] == text
    assert (rows[0].dag, rows[0].run, rows[0].task) == ("d1", "manual__2024-01-01T00:00:00+00:00", "t1")
    assert logs.read_logs(spark, str(tmp_path), since="2999-01-01T00:00:00").count() == 0


class Recorder:
    """Stands in for a DataFrameWriter: no database may be started here."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **values):
        self.calls.update(values)
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self


def test_jdbc_write_of_an_empty_frame_truncates(spark, monkeypatch):
    writer = Recorder()
    writer.save = lambda: None

    class Seen:
        get = {"rows": 0}

    class Frame:
        columns, write = ["a"], writer
        drop = observe = lambda self, *_: self

    monkeypatch.setattr(jdbc, "Observation", Seen)
    assert jdbc.write_jdbc(Frame(), "t", {"url": "u"}, "overwrite") == 0
    assert (writer.calls["mode"], writer.calls["truncate"], writer.calls["dbtable"]) == ("overwrite", True, "t")


def test_internal_columns_are_dropped(spark):
    empty = spark.createDataFrame([], "a int, _b int")
    assert jdbc.drop_internal(empty).columns == ["a"]


def test_jdbc_read_options(monkeypatch):
    class Session:
        read = Recorder()

    Session.read.load = lambda: "frame"
    got = jdbc.read_jdbc(Session, "t", {"url": "u"}, "id", 0, 100, 8)
    assert got == "frame"
    assert Session.read.calls == {
        "format": "jdbc", "url": "u", "dbtable": "t", "partitionColumn": "id",
        "lowerBound": 0, "upperBound": 100, "numPartitions": 8,
    }


def test_topic_options():
    class Session:
        readStream = Recorder()

    Session.readStream.load = lambda: "frame"
    streams.read_topic(Session, "host", "states")
    assert Session.readStream.calls == {
        "format": "kafka", "kafka.bootstrap.servers": "host", "subscribe": "states",
        "startingOffsets": "latest", "failOnDataLoss": False,
    }


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", None])
def test_cluster_needs_a_shared_folder(master):
    class Conf:
        def get(self, key, default=None):
            return master if key == "spark.master" and master else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_root(Session)


def test_batches_replace_themselves_under_any_name(spark, tmp_path):
    path, name = str(tmp_path / "t"), "manual__2026-01-04T15:12:49+00:00 ü/%"
    for rows in (5, 3):
        sinks.replace_batch(spark.range(rows), path, name)
    sinks.replace_batch(spark.range(2), path, "other")
    got = spark.read.schema("id bigint, batch string").parquet(path).groupBy("batch").count().collect()
    assert {tuple(r) for r in got} == {(name, 3), ("other", 2)}


def test_route_files(spark, tmp_path):
    from trackloom.sources import routes

    exact = tmp_path / "exact.csv"
    exact.write_text("callsign,origin,destination,airline\nigo1 ,del,bom,x\nIGO2,ccu,del,x\nIGO1,blr,maa,x\n")
    got = {r.callsign: (r.origin_code, r.destination_code) for r in routes.read_exact_routes(spark, str(exact)).collect()}
    assert got == {"IGO1": ("BLR", "MAA"), "IGO2": ("CCU", "DEL")}
    plan = tmp_path / "schedule.csv"
    plan.write_text("FlightNo, Origin ,Destination,ScheduledDepartureTime\n6E1,DEL,MAA,1\n6E1,BOM,DEL,2\nZZ2,DEL,BOM,3\n")
    read = lambda **o: {r.callsign: r.origin_code for r in routes.read_route_schedule(spark, str(plan), **o).collect()}
    assert read() == {"IGO1": "BOM", "UNK2": "DEL"}
    assert read(last_wins=True) == {"IGO1": "BOM", "UNK2": "DEL"}
    assert read(known_only=True) == {"IGO1": "BOM"}
    plan.write_text("FlightNo,Origin,Destination\n6E1,BOM,DEL\n6E1,DEL,MAA\n")
    assert read(last_wins=True) == {"IGO1": "DEL"} and read() == {"IGO1": "BOM"}
    assert "callsign" in routes.schedule_or_rules(spark, str(plan)).columns
    assert "min_flight_num" in routes.schedule_or_rules(spark, str(tmp_path / "none.csv")).columns


def test_counting_while_writing_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, year int, month int")
    for i, frame in enumerate((empty, empty.filter("a > 1"), spark.range(5).filter("false"))):
        out, seen = sinks.counted(frame)
        out.write.parquet(str(tmp_path / str(i)))
        assert seen.get["rows"] == 0
