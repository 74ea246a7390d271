import json

import pytest
from pyspark.sql import functions as F
from test_sources import HEADER, add_tar, line

from trackloom import functions as fn
from trackloom.catalog import views
from trackloom.operators import ops, serving
from trackloom.operators.merge import merge_unified
from trackloom.plans.layers import MissingMapping, bronze_job, gold_job, mapping_job, sample_job, silver_job
from trackloom.plans.ops import ops_job
from trackloom.plans.serving import serving_job
from trackloom.plans.star import STAR_TABLES, star_job
from trackloom.sources.logs import read_logs
from trackloom.streaming.serve import serving_table


def test_layers_end_to_end(spark, tmp_path):
    p = {n: str(tmp_path / n) for n in ("raw", "history", "mapping", "region", "bronze", "silver", "speed", "gold", "star")}
    text = "\n".join([HEADER] + [line(1_704_067_200 + i, "igo1 " if i % 2 else "ZZZ9", 10.0 if i % 4 else 50.0) for i in range(80)])
    add_tar(tmp_path / "raw/a.tar", [("a.csv.gz", text)])
    add_tar(tmp_path / "raw/b.tar", [("b.csv.gz", text)], cut=700)
    (tmp_path / "history").mkdir()
    (tmp_path / "history/h.csv").write_text(
        "callsign,estdepartureairport,airportofdeparture,estarrivalairport,airportofdestination,model,typecode\n"
        "igo1 ,VIDP,,VABB,,A320,T\nIGO1,VIDP,,VABB,,A320,T\nXX1,EGLL,,KJFK,,,\nXX2,,,KJFK,,,\n"
    )
    with pytest.raises(MissingMapping):
        silver_job(spark, p["bronze"], p["mapping"], p["silver"])
    figures = mapping_job(spark, p["history"], p["mapping"], p["region"])
    assert figures == {"total_records": 4, "unique_callsigns": 2, "valid_records": 3, "region_routes": 1}
    assert bronze_job(spark, p["raw"], p["bronze"]) == {"records": 60, "broken_archives": 1}
    assert silver_job(spark, p["bronze"], p["mapping"], p["silver"]) == {
        "records": 60, "matched": 40, "match_rate": 66.7
    }
    assert silver_job(spark, p["bronze"], p["mapping"], p["silver"], since=(2024, 1))["records"] == 60
    assert gold_job(spark, p["silver"], p["speed"], p["gold"]) == {"gold_records": 60}
    assert sample_job(spark, p["silver"], str(tmp_path / "all"), 1.0) == {"records": 60}
    few = sample_job(spark, p["silver"], str(tmp_path / "few"), 0.5)
    assert 10 < few["records"] < 50
    # the same load again changes nothing; another one adds its rows
    assert bronze_job(spark, p["raw"], p["bronze"]) == {"records": 60, "broken_archives": 1}
    assert spark.read.parquet(p["bronze"]).count() == 60
    bronze_job(spark, p["raw"], p["bronze"], batch="2024-01-02T00:00:00")
    assert spark.read.parquet(p["bronze"]).count() == 120
    rows = star_job(spark, p["gold"], p["star"])
    assert set(rows) == set(STAR_TABLES)
    assert rows["raw_telemetry"] == 60 and rows["fact_flight_history"] == 2


def test_gold_full_and_incremental(spark, sf_dir, tmp_path):
    silver, speed, gold = (str(tmp_path / n) for n in ("silver", "speed", "gold"))
    views.silver(spark, sf_dir).drop("event_id").write.partitionBy("year", "month").parquet(silver)
    assert gold_job(spark, silver, speed, gold, full=False) == {"gold_records": 0}
    total = spark.read.parquet(silver).count()
    assert gold_job(spark, silver, speed, gold) == {"gold_records": total}
    views.speed_layer(spark, sf_dir).drop("event_id").write.partitionBy("year", "month", "day", "hour").parquet(speed)
    for _ in range(2):  # repeating the load changes nothing
        assert gold_job(spark, silver, speed, gold, full=False) == {"gold_records": total}
        assert spark.read.parquet(gold).count() == 2 * total
    assert gold_job(spark, silver, speed, gold) == {"gold_records": 2 * total}
    merged = spark.read.parquet(gold)
    assert merged.filter(F.col("time").isNull()).count() == 0
    published = {}
    star_job(spark, gold, str(tmp_path / "star"), sample=0.1,
             publish=lambda df, name: published.setdefault(name, df.count()))
    assert set(published) == {*STAR_TABLES, "raw_telemetry_sample"}
    assert published["raw_telemetry"] == 2 * total
    assert 0.05 < published["raw_telemetry_sample"] / (2 * total) < 0.15
    assert gold_job(spark, silver, speed, str(tmp_path / "once"), distinct=True)["gold_records"] <= 2 * total


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_serving_full_then_incremental(spark, sf_dir, tmp_path):
    batch, speed, root = (str(tmp_path / n) for n in ("batch", "speed", "root"))
    silver = views.silver(spark, sf_dir).drop("event_id")
    live = views.speed_layer(spark, sf_dir).drop("event_id")
    early = F.col("day") <= 10
    assert serving_job(spark, batch, speed, root, "r0") == {"states": 0, "files": 0}
    silver.filter(early).write.partitionBy("year", "month").parquet(batch)
    first = serving_job(spark, batch, speed, root, "r1", full=True)
    assert first["states"] == silver.filter(early).count() and first["files"] > 0
    assert serving_job(spark, batch, speed, root, "r2") == {"states": 0, "files": 0}
    silver.filter(~early).write.mode("append").partitionBy("year", "month").parquet(batch)
    live.write.partitionBy("year", "month", "day", "hour").parquet(speed)
    second = serving_job(spark, batch, speed, root, "r3")
    assert second["states"] == silver.filter(~early).count() + live.count()
    whole = merge_unified(silver, live)
    for table in serving.SERVING_TABLES:
        merged, direct = serving_table(spark, root, table), table.build(whole)
        exact = [c for c in direct.columns if not c.startswith("avg")]
        assert rows_of(merged.select(exact)) == rows_of(direct.select(exact))
    # a full load drops what came before and gives the same tables
    published = {}
    full = serving_job(spark, batch, speed, root, "r4", full=True,
                       publish=lambda df, name: published.setdefault(name, df.count()))
    assert full["states"] == whole.count() and len(published) == 4
    assert spark.read.parquet(f"{root}/states").count() == whole.count()


def test_serving_load_repeated_after_failure_counts_once(spark, sf_dir, tmp_path, monkeypatch):
    from trackloom.plans import serving as plan

    batch, speed, root = (str(tmp_path / n) for n in ("batch", "speed", "root"))
    silver = views.silver(spark, sf_dir).drop("event_id")
    silver.write.partitionBy("year", "month").parquet(batch)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(plan, "append_ledger", fail)
        with pytest.raises(RuntimeError):
            serving_job(spark, batch, speed, root, "r1")
    assert serving_job(spark, batch, speed, root, "r1")["states"] == silver.count()
    assert spark.read.parquet(f"{root}/states").count() == silver.count()
    hours = serving_table(spark, root, serving.HOURLY_STATS)
    assert hours.agg(F.sum("total_flights")).first()[0] == silver.count()


def test_load_repeated_after_new_files_keeps_its_own(spark, sf_dir, tmp_path):
    batch, speed, root = (str(tmp_path / n) for n in ("batch", "speed", "root"))
    silver = views.silver(spark, sf_dir).drop("event_id")
    run, early = "manual__2026-01-04T15:12:49+00:00", F.col("day") <= 10
    silver.filter(early).write.partitionBy("year", "month").parquet(batch)
    serving_job(spark, batch, speed, root, run)
    silver.filter(~early).write.mode("append").partitionBy("year", "month").parquet(batch)
    assert serving_job(spark, batch, speed, root, run)["states"] == silver.count()
    assert serving_job(spark, batch, speed, root, "later") == {"states": 0, "files": 0}
    assert spark.read.parquet(f"{root}/states").count() == silver.count()
    ledger = spark.read.parquet(f"{root}/ledger")
    assert ledger.count() == ledger.select("file_path").distinct().count() > 0


MARK = (
    "[2026-01-04] {{t.py:1}} INFO - Marking task as {state}. dag_id={dag}, task_id={task}, "
    "execution_date=20260104T151249, start_date=20260104T15{start}, end_date=20260104T15{end}\n"
)


def test_ops_reports(spark, tmp_path):
    def log(run, task, body):
        folder = tmp_path / "logs" / "dag_id=d" / f"run_id={run}" / f"task_id={task}"
        folder.mkdir(parents=True)
        (folder / "attempt=1.log").write_text(body)

    log("r1", "a", "plain\nan Error here\n" + MARK.format(state="SUCCESS", dag="d", task="a", start="0000", end="0030"))
    log("r1", "b", MARK.format(state="FAILED", dag="d", task="b", start="0020", end="0110"))
    log("r2", "a", "".join(f"warning {i}\n" for i in range(50)))
    (tmp_path / "logs" / "spark_wrapper.log").write_text("fatal thing\nplain\n")
    logs = read_logs(spark, str(tmp_path / "logs"))
    run = ops.task_metrics(logs).collect()
    assert len(run) == 1
    run = run[0]
    assert (run.dag, run.run, run.tasks, run.successful_tasks, run.failed_tasks) == ("d", "r1", 2, 1, 1)
    assert (run.total_task_seconds, run.wall_seconds, run.mean_task_seconds) == (80, 70, 40.0)
    assert run.efficiency_pct == pytest.approx(8000 / 70)
    found = ops.log_summary(logs, lines_per_file=10).collect()
    by_file = {}
    for r in found:
        by_file.setdefault((r.dag, r.file.split("run_id=")[-1].split("/")[0]), []).append(r)
    tail = sorted(by_file["d", "r2"], key=lambda r: r.from_end)
    assert [r.line for r in tail] == [f"warning {i}" for i in range(49, 39, -1)]
    assert tail[0].important_lines == 50 and tail[0].file_rank in (1, 2, 3)
    assert [r.line for rs in by_file.values() for r in rs if r.dag == "system-logs"] == ["fatal thing"]
    assert max(r.file_rank for r in ops.log_summary(logs, files_per_group=2).collect()) == 2

    layer = tmp_path / "layer"
    for name in ("b/x", "a/y", "a/z"):
        (layer / name).parent.mkdir(parents=True, exist_ok=True)
        (layer / name).write_text("12345")
    report = ops_job(spark, str(tmp_path / "logs"), {"gold": str(layer)})
    assert [tuple(r) for r in report["storage"].collect()] == [("gold", 3, 15)]
    folders = ops.folder_metrics(spark, str(layer), 1).collect()
    assert [(r.folder.rsplit("/", 1)[1], r.files) for r in folders] == [("a", 2)]
    assert json.dumps([r.dag for r in report["tasks"].collect()]) == '["d"]'


def test_bronze_takes_every_file_once(spark, tmp_path):
    """Without a name nothing is replaced, whatever comes into the folder and whatever the bounds."""
    raw, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    rows = "\n".join([HEADER] + [line(1_704_067_200 + i, "IGO1", 10.0) for i in range(10)])
    count = lambda: spark.read.parquet(bronze).count()
    add_tar(raw / "a.tar", [("a.csv.gz", rows)])
    assert bronze_job(spark, str(raw), bronze)["records"] == 10
    add_tar(raw / "b.tar", [("b.csv.gz", rows)])
    assert bronze_job(spark, str(raw), bronze)["records"] == 10 and count() == 20
    assert bronze_job(spark, str(raw), bronze)["records"] == 20 and count() == 20
    assert bronze_job(spark, str(raw), bronze, modified_after="2000-01-01T00:00:00")["records"] == 20 and count() == 20
    assert bronze_job(spark, str(raw), bronze, modified_before="2000-01-01T00:00:00")["records"] == 0 and count() == 20
    add_tar(tmp_path / "more/c.tar", [("c.csv.gz", rows)])
    assert bronze_job(spark, str(tmp_path / "more"), bronze)["records"] == 10 and count() == 30


def test_bronze_load_that_was_lost_is_done_again(spark, tmp_path, monkeypatch):
    from trackloom.plans import layers

    add_tar(tmp_path / "raw/a.tar", [("a.csv.gz", "\n".join([HEADER, line(1_704_067_200, "IGO1", 10.0)]))])
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    whole = layers.replace_batch

    def lost(df, path, *args, **how):
        if path.endswith("_files"):
            raise RuntimeError("lost")
        whole(df, path, *args, **how)

    with monkeypatch.context() as m:
        m.setattr(layers, "replace_batch", lost)
        with pytest.raises(RuntimeError):
            bronze_job(spark, raw, bronze)
    assert bronze_job(spark, raw, bronze)["records"] == 1
    assert spark.read.parquet(bronze).count() == 1


@pytest.mark.parametrize("distinct", [False, True])
def test_gold_window_is_the_same_in_any_load(spark, sf_dir, tmp_path, distinct):
    silver, speed = str(tmp_path / "silver"), str(tmp_path / "speed")
    states = views.silver(spark, sf_dir).withColumn("time", F.col("time") + F.col("event_id") % 200 * 86_400)
    states = fn.with_date_parts(states).drop("event_id")
    states.write.partitionBy("year", "month").parquet(silver)
    gold_job(spark, silver, speed, str(tmp_path / "a"), days=40, distinct=distinct)
    moved = {c: F.col(c) + 230 * 86_400 for c in ("time_position", "last_contact")}
    layer = fn.with_date_parts(views.speed(spark, sf_dir).drop("event_id").withColumns(moved), "last_contact")
    layer.withColumn("hour", fn.utc_hour("last_contact")).write.partitionBy("year", "month", "day", "hour").parquet(speed)
    gold_job(spark, silver, speed, str(tmp_path / "a"), full=False, days=40, distinct=distinct)
    gold_job(spark, silver, speed, str(tmp_path / "b"), days=40, distinct=distinct)
    a, b = (spark.read.parquet(str(tmp_path / n)).select(*states.columns, "data_source") for n in "ab")
    assert rows_of(a) == rows_of(b) and a.filter("data_source = 'batch'").count() > 0
    newest = a.agg(F.max("time")).first()[0]
    assert a.agg(F.min("time")).first()[0] >= newest - 40 * 86_400
