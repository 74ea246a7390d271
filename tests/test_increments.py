"""Star tables load by load, dictionaries, moments and stretches of a track."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from trackloom.catalog import views
from trackloom.operators import codes, increments, star, tracks
from trackloom.plans.star import STAR_TABLES, read_star, star_job, star_load


def rows_of(df):
    """Rows as sorted texts; numbers to nine digits, as sums are added in another order."""
    short = lambda v: f"{round(v, 9) + 0.0:.9g}" if isinstance(v, float) else str(v)
    return sorted(" | ".join(map(short, r)) for r in df.select(*sorted(df.columns)).collect())


def gold_of(spark, sf_dir, path):
    views.silver(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_loads_in_any_order_give_the_tables_of_one_build(spark, sf_dir, tmp_path):
    gold = gold_of(spark, sf_dir, str(tmp_path / "gold"))
    star_job(spark, str(tmp_path / "gold"), str(tmp_path / "whole"))
    root = str(tmp_path / "loads")
    parts = [gold.filter(F.col("event_id") % 3 == k) for k in range(3)]
    for batch, part in (("b", parts[1]), ("a", parts[0]), ("c", parts[2]), ("a", parts[0])):
        star_load(spark, part, root, batch)
    for table in STAR_TABLES:
        whole = spark.read.parquet(str(tmp_path / "whole" / table))
        assert rows_of(read_star(spark, root, table)) == rows_of(whole), table


def test_a_load_reads_only_its_months(spark, sf_dir, tmp_path):
    gold = gold_of(spark, sf_dir, str(tmp_path / "gold"))
    root = str(tmp_path / "star")
    later = gold.withColumn("time", F.col("time") + 86_400 * 70)
    assert star_load(spark, gold, root, "1", ["fact_flight_history"])["months"] >= 1
    before = {f: 1 for f in spark.read.parquet(f"{root}/fact_flight_history").inputFiles()}
    star_load(spark, later, root, "2", ["fact_flight_history"])
    after = spark.read.parquet(f"{root}/fact_flight_history").inputFiles()
    assert set(before) < set(after)  # the files of the first load's months are as they were


def test_a_repeated_load_can_lose_its_last_rows(spark, sf_dir, tmp_path):
    gold = gold_of(spark, sf_dir, str(tmp_path / "gold"))
    root = str(tmp_path / "star")
    later = gold.withColumn("time", F.col("time") + 86_400 * 70)
    star_load(spark, gold, root, "1")
    star_load(spark, later, root, "2")
    star_load(spark, later.filter("false"), root, "2")
    star_job(spark, str(tmp_path / "gold"), str(tmp_path / "whole"))
    for table in STAR_TABLES:
        assert rows_of(read_star(spark, root, table)) == rows_of(spark.read.parquet(str(tmp_path / "whole" / table))), table


def test_rows_without_keys(spark, sf_dir, tmp_path):
    odd = views.silver(spark, sf_dir).limit(60)
    for c in ("icao24", "callsign", "time", "route"):
        odd = odd.unionByName(odd.limit(20).withColumn(c, F.lit(None).cast(dict(odd.dtypes)[c])))
    odd.write.parquet(str(tmp_path / "gold"))
    gold = spark.read.parquet(str(tmp_path / "gold"))
    star_job(spark, str(tmp_path / "gold"), str(tmp_path / "whole"))
    root = str(tmp_path / "star")
    star_load(spark, gold.filter("event_id % 2 = 0"), root, "x")
    star_load(spark, gold.filter("event_id % 2 = 1"), root, "y")
    for table in STAR_TABLES:
        assert rows_of(read_star(spark, root, table)) == rows_of(spark.read.parquet(str(tmp_path / "whole" / table))), table


def test_moments_keep_their_digits(spark):
    """Values far from zero, whose squares would lose the spread."""
    draw = random.Random(3)
    values = [1e9 + draw.random() for _ in range(500)]
    rows = [(k % 7, v) for k, v in enumerate(values)] + [(9, None)]
    parts = spark.createDataFrame(rows, "load int, v double").groupBy("load").agg(increments.moments("v").alias("m"))
    got = parts.agg(increments.merged_moments("m").alias("m")).select("m.*", increments.sample_stddev(F.col("m")).alias("s")).first()
    assert got.n == 500 and got.mean == pytest.approx(statistics.fmean(values), rel=1e-15)
    assert got.s == pytest.approx(statistics.stdev(values), rel=1e-6)
    empty = parts.filter("load = 9").agg(increments.merged_moments("m").alias("m")).first().m
    assert (empty.n, empty.mean, empty.m2) == (0, 0.0, 0.0)


def test_codes_stay_and_are_dense(spark):
    text = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("value"))
    first = codes.new_codes(text.filter("value < 'k5'").unionByName(text.limit(0)), None)
    second = codes.new_codes(text.unionByName(spark.createDataFrame([(None,)], "value string")), first)
    assert second.join(first, "value").count() == 0
    both = first.unionByName(second)
    figures = both.agg(F.count("*"), F.countDistinct("value"), F.countDistinct("code"), F.min("code"), F.max("code")).first()
    assert figures[:3] == (20_000, 20_000, 20_000) and figures[3] >= 1
    assert figures[4] < 2 * 20_000  # few gaps


def test_distinct_counts_merge(spark):
    rows = spark.range(200_000).select(F.col("id").alias("code"), (F.col("id") % 3).alias("load"), (F.col("id") % 5).alias("cell"))
    again = rows.filter("load = 1").withColumn("load", F.lit(7).cast("long"))
    parts = rows.unionByName(again).filter("code > 0").groupBy("load", "cell", codes.bitmap_group("code").alias("group")).agg(
        codes.bitmap_of("code").alias("seen")
    )
    merged = parts.groupBy("cell", "group").agg(F.bitmap_or_agg("seen").alias("seen")).groupBy("cell").agg(F.sum(F.bitmap_count("seen")))
    assert sorted(map(tuple, merged.collect())) == [(0, 39_999)] + [(k, 40_000) for k in range(1, 5)]


def test_stretches_join_in_any_grouping(spark):
    draw = random.Random(6)
    rows = [(draw.choice("ab"), draw.randrange(9_000), draw.uniform(-60, 60), draw.uniform(-170, 170)) for _ in range(400)]
    df = spark.createDataFrame(rows, "icao24 string, time long, lat double, lon double")
    want = {(r.icao24): (round(r.distance_km, 6), r.positions) for r in tracks.track_distance(df).collect()}
    keys = ["icao24"]
    loads = [tracks.bucket_points(tracks.positions(df.filter(F.col("time") % 4 == k), keys), keys) for k in range(4)]
    points = loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(loads[3])
    merged = tracks.joined_stretches(tracks.stretches(points, keys, merge=True), keys)
    assert {r.icao24: (round(r.distance_km, 6), r.positions) for r in merged.collect()} == want


def test_partials_are_reduced_before_the_shuffle(spark, sf_dir, tmp_path):
    from test_plans import heavy_aggregates, plan

    gold = gold_of(spark, sf_dir, str(tmp_path / "gold"))
    text = plan(increments.flight_partials(gold))
    assert [k for _, k in heavy_aggregates(text)] == ["HashAggregate", "HashAggregate"]
    assert "Window" not in plan(star.fact_flight_history(gold))


def test_a_backlog_is_merged_once_and_a_broken_merge_made_up_for(spark, sf_dir, tmp_path, monkeypatch):
    from trackloom.plans import star as plan

    gold = gold_of(spark, sf_dir, str(tmp_path / "gold"))
    star_job(spark, str(tmp_path / "gold"), str(tmp_path / "whole"))
    root, merged, refresh = str(tmp_path / "star"), [], plan._refresh

    def broken(spark, path, layouts, months, tables):
        merged.append(list(months))
        if len(merged) == 1:
            raise RuntimeError("lost on the way")
        refresh(spark, path, layouts, months, tables)

    monkeypatch.setattr(plan, "_refresh", broken)
    for batch, kept in (("a", "event_id % 2 = 0"), ("b", "event_id % 2 = 1"), ("a", "event_id % 2 = 0")):
        star_load(spark, gold.filter(kept), root, batch, refresh=False)
    assert merged == []
    with pytest.raises(RuntimeError):
        plan.refresh_star(spark, gold, root)
    assert plan.refresh_star(spark, gold, root) == len(merged[0]) >= 1
    assert merged[1] == merged[0] and plan.refresh_star(spark, gold, root) == 0
    for table in STAR_TABLES:
        assert rows_of(read_star(spark, root, table)) == rows_of(spark.read.parquet(str(tmp_path / "whole" / table))), table
