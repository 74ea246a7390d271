"""Hand-made cases for the traps of each operator."""

import heapq
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackloom import reference_data as ref
from trackloom.operators import filters, live, lookup, merge, serving, sites, star, tracks
from trackloom.sources import dims


def km(a, b):
    la, lo, ma, mo = map(math.radians, (*a, *b))
    h = math.sin((ma - la) / 2) ** 2 + math.cos(la) * math.cos(ma) * math.sin((mo - lo) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, h)))


def test_region_keeps_box_or_prefix(spark):
    rows = [
        (1, 0, 6.0, 70.0, "zzz"), (2, 0, 5.9, 70.0, "zzz"), (3, 0, None, None, " aic1 "),
        (4, 0, None, None, None), (5, 0, 10.0, 70.0, None), (6, 0, 50.0, 70.0, "6e12"),
    ]
    df = spark.createDataFrame(rows, "id int, time bigint, lat double, lon double, callsign string")
    kept = filters.filter_region(df)
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5, 6]
    assert kept.columns[-3:] == ["year", "month", "day"]


def rules(spark, rows):
    ddl = ("rule_rank int, airline_prefix string, min_flight_num int, max_flight_num int, "
           "origin_code string, destination_code string")
    return dims.literal_rows(spark, rows, ddl)


def test_overlapping_rules(spark):
    table = rules(spark, [(0, "VTI", 800, 899, "DEL", "BOM"), (1, "VTI", 810, 819, "DEL", "BLR")])
    df = lookup.with_callsign_parts(
        spark.createDataFrame([("VTI815 ",), ("VTI805",), ("VTI700",), ("XXX1",)], "callsign string")
    )
    first = {r.callsign: r.destination_code for r in lookup.enrich_by_rules(df, table).collect()}
    assert first == {"VTI815": "BOM", "VTI805": "BOM", "VTI700": None, "XXX1": None}
    every = lookup.enrich_by_rules(df, table, "all", keep_unmatched=False).collect()
    assert sorted((r.callsign, r.destination_code) for r in every) == [
        ("VTI805", "BOM"), ("VTI815", "BLR"), ("VTI815", "BOM")
    ]
    with pytest.raises(ValueError):
        lookup.enrich_by_rules(df, table, "some")


def test_rule_that_comes_later_in_storage_but_first_in_rank_wins(spark):
    table = rules(spark, [(5, "IGO", 1, 9, "A", "B"), (2, "IGO", 1, 9, "C", "D")])
    df = lookup.with_callsign_parts(spark.createDataFrame([("IGO5",)], "callsign string"))
    assert lookup.enrich_by_rules(df, table).first().origin_code == "C"


def test_many_overlapping_rules_of_one_prefix(spark):
    draw = np.random.default_rng(5)
    n = 50_000
    low = draw.integers(-1000, 900_000, n)
    high = low + draw.integers(-5, 20_000, n)
    rank = draw.permutation(n)
    frame = pd.DataFrame({"rule_rank": rank, "airline_prefix": "VTI", "min_flight_num": low, "max_flight_num": high})
    table = spark.createDataFrame(frame.assign(origin_code=frame.rule_rank.astype(str), destination_code="X"))
    asked = np.unique(np.concatenate([draw.integers(-2000, 930_000, 1500), low[:200], high[:200], high[:200] + 1]))
    df = spark.createDataFrame(pd.DataFrame({"airline_prefix": "VTI", "flight_number": asked}))
    got = {r.flight_number: r.rule_rank for r in lookup.enrich_by_rules(df, table).collect()}
    for x in asked:
        holds = rank[(low <= x) & (x <= high)]
        assert got[x] == (holds.min() if len(holds) else None)


def test_rules_at_the_ends_of_numbers_and_without_rank(spark):
    top = 2**31 - 1
    table = rules(spark, [
        (0, "A", 0, 0, "a", "z"), (1, "A", 0, top, "b", "z"), (2, "A", -top, top, "c", "z"), (3, "A", 9, 3, "d", "z"),
        (4, "B", None, 5, "e", "z"), (5, None, 1, 5, "f", "z"), (6, "C", 5, 5, "h", "z"), (7, "C", 5, 5, "g", "z"),
    ])
    rows = [("A", 0), ("A", 1), ("A", -1), ("A", top), ("A", -top), ("A", None), ("B", 1), (None, 2), ("C", 5), ("C", 4), ("D", 1)]
    df = spark.createDataFrame(rows, "airline_prefix string, flight_number int")
    got = {(r[0], r[1]): r.origin_code for r in lookup.enrich_by_rules(df, table).collect()}
    assert got == {
        ("A", 0): "a", ("A", 1): "b", ("A", -1): "c", ("A", top): "b", ("A", -top): "c", ("A", None): None,
        ("B", 1): None, (None, 2): None, ("C", 5): "h", ("C", 4): None, ("D", 1): None,
    }
    by_values = lookup.enrich_by_rules(df.filter("airline_prefix = 'C'"), table.drop("rule_rank"))
    assert {(r[1], r.origin_code) for r in by_values.collect()} == {(5, "g"), (4, None)}


def test_schedule_rules(spark):
    rows = [
        ("6E102", "DEL", "BOM"), ("6E102", "BOM", "DEL"), ("AI7", "DEL", "DEL"),
        ("ZZ9", "DEL", "BOM"), ("SG", "DEL", "BOM"), (None, "DEL", "BOM"), ("UK1", None, "BOM"),
    ]
    df = spark.createDataFrame(rows, "FlightNo string, Origin string, Destination string")
    got = lookup.route_schedule(df, dims.schedule_carriers(spark), dims.airports(spark))
    found = {r.callsign: (r.origin_code, r.airline_name, r.origin_city) for r in got.collect()}
    assert found == {
        "IGO102": ("BOM", "IndiGo", "Mumbai"),
        "UNK9": ("DEL", "Unknown", "Delhi"),
        "UNK": ("DEL", "Unknown", "Delhi"),
    }
    known = lookup.route_schedule(
        df, dims.schedule_carriers(spark), dims.airports(spark), known_only=True
    )
    assert [r.callsign for r in known.collect()] == ["IGO102"]


def test_lookup_takes_pairs_whole(spark):
    ddl = "callsign string, origin_code string, destination_code string"
    first = dims.literal_rows(spark, [("IGO1", "AAA", "BBB")], ddl)
    second = dims.literal_rows(spark, [("IGO1", "CCC", "DDD"), ("IGO2", "EEE", "FFF")], ddl)
    df = spark.createDataFrame([(" igo1",), ("IGO2",), (None,)], "callsign string")
    got = {r.callsign: (r.origin_code, r.destination_code) for r in lookup.lookup_exact(df, first, second).collect()}
    assert got == {" igo1": ("AAA", "BBB"), "IGO2": ("EEE", "FFF"), None: (None, None)}


def test_exact_route_table_takes_the_last_row(spark):
    rows = [(1, "igo1 ", "del", "bom"), (2, "IGO1", "ccu", "bom"), (3, "IGO2", "a", "b")]
    df = spark.createDataFrame(rows, "n int, callsign string, origin string, destination string")
    got = {r.callsign: r.origin_code for r in lookup.exact_route_table(df, ["n"]).collect()}
    assert got == {"IGO1": "CCU", "IGO2": "A"}


@pytest.mark.parametrize("radius", [0.5, 15.0, 50.0, 500.0, 5000.0, 19000.0])
def test_nearest_site_equals_brute_force(spark, radius):
    rng = random.Random(int(radius))
    places = [("S%d" % i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)]
    places += [("N", 89.9, 10.0), ("S", -90.0, 0.0), ("W", 0.0, -179.99), ("E", 10.0, 180.0)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)]
    points += [(300, 90.0, 0.0), (301, -89.95, 179.0), (302, 0.0, 179.99), (303, 10.0, -180.0)]
    for i, (_, la, lo) in enumerate(places):
        points.append((400 + i, max(-90.0, min(90.0, la + rng.uniform(-0.2, 0.2))), lo))
    points.append((999, None, 1.0))
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    table = dims.literal_rows(spark, places, "code string, lat double, lon double")
    got = {r.id: (r.site_code, r.site_km) for r in sites.nearest_site(df, table, radius).collect()}
    assert len(got) == len(points)
    for i, la, lo in points:
        reach = [] if la is None else sorted(
            (km((la, lo), (sa, so)), code) for code, sa, so in places
        )
        reach = [x for x in reach if x[0] <= radius]
        if not reach:
            assert got[i] == (None, None)
        else:
            assert got[i][0] == reach[0][1] and got[i][1] == pytest.approx(reach[0][0], abs=1e-6)


@pytest.mark.parametrize("radius", [3.0, 500.0, 19000.0])
def test_two_nearest_sites_of_many_equal_brute_force(spark, radius):
    rng = random.Random(int(radius) + 1)
    places = [(f"S{i:03}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    places += [(f"C{i:03}", 89.0 + rng.random(), rng.uniform(-180, 180)) for i in range(90)]
    places += [(f"D{i:03}", rng.uniform(-1, 1), 180 - rng.random() if i % 2 else rng.random() - 180) for i in range(90)]
    points = [(i, *rng.choice(places)[1:]) for i in range(150)] + [(200 + i, rng.uniform(88, 90), rng.uniform(-180, 180)) for i in range(50)]
    points = [(i, min(90.0, la + rng.uniform(-0.3, 0.3)), lo) for i, la, lo in points]
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    table = spark.createDataFrame(places, "code string, lat double, lon double")
    got = {r.id: [x.code for x in r._ranked[:2]] for r in sites.with_ranked_sites(df, table, radius).collect()}
    for i, la, lo in points:
        near = heapq.nsmallest(2, ((km((la, lo), (sa, so)), code) for code, sa, so in places))
        assert got[i] == [c for d, c in near if d <= radius], i


def test_radius_edges(spark):
    step = 180 / (math.pi * 6371)
    df = spark.createDataFrame([(1, 49.9 * step, 0.0), (2, 50.1 * step, 0.0)], "id int, lat double, lon double")
    table = dims.literal_rows(spark, [("A", 0.0, 0.0)], "code string, lat double, lon double")
    got = {r.id: r.site_code for r in sites.nearest_site(df, table).collect()}
    assert got == {1: "A", 2: None}


def test_position_guess(spark):
    rows = [
        (1, 28.56, 77.1, 10.0, 0.0, True),       # parked at DEL
        (2, 28.56, 77.1, 900.0, 80.0, None),     # low at DEL
        (3, 28.56, 77.1, 9000.0, 200.0, False),  # cruising above DEL
        (4, 20.0, 75.0, 9000.0, 40.0, False),    # too slow
        (5, 20.0, 75.0, None, 200.0, True),      # on the ground, no site near
        (6, 60.0, 10.0, 9000.0, 200.0, False),   # far away
        (7, 20.0, 75.0, 9000.0, 200.0, True),    # flag says ground, no site near: cruise rule
    ]
    df = spark.createDataFrame(
        rows, "id int, lat double, lon double, baroaltitude double, velocity double, onground boolean"
    )
    got = {
        r.id: (r.origin_code, r.destination_code, r.confidence)
        for r in sites.route_from_position(df, dims.airports(spark, ref.LIVE_AIRPORT_CODES)).collect()
    }
    assert got[1] == got[2] == ("DEL", None, "low")
    assert got[3] == (None, None, "none")  # only one site within 500 km
    assert got[4] == got[5] == got[6] == (None, None, "none")
    assert got[7][2] == "low" and got[7][0] and got[7][1]


def test_hybrid_examples(spark):
    rows = [
        ("IGO981", 28.5, 77.1, 10000.0, None, False), ("AIC118", 19.0, 72.9, 100.0, None, True),
        ("IGO9999", 20.0, 75.0, 8000.0, None, False), ("ZZZ1", 20.0, 75.0, 0.0, 8000.0, None),
        ("IGO9998", 19.09, 72.87, 2000.0, None, True), ("IGO9997", 0.0, 75.0, 8000.0, None, False),
        (None, 20.0, 75.0, 8000.0, None, False),
    ]
    df = spark.createDataFrame(
        rows,
        "callsign string, latitude double, longitude double, baro_altitude double, "
        "geo_altitude double, on_ground boolean",
    )
    none = dims.literal_rows(spark, [], "callsign string, origin_code string, destination_code string")
    got = {
        r.callsign: r
        for r in sites.enrich_hybrid(
            df, none, dims.exact_routes(spark), dims.hybrid_airports(spark), dims.airlines(spark)
        ).collect()
    }
    assert got["IGO981"].route_detection_method == "exact_database"
    assert (got["IGO981"].origin_code, got["IGO981"].destination_city) == ("DEL", "Hyderabad")
    assert got["AIC118"].airline_name == "Air India"
    assert got["IGO9999"].route_detection_method == "geographic"
    assert got["ZZZ1"].route_detection_method == "geographic" and got["ZZZ1"].airline_name is None
    assert got["IGO9998"].route_detection_method is None and got["IGO9998"].airline_name is None
    assert got["IGO9997"].route_detection_method is None
    assert got[None].route_detection_method == "geographic"


def test_endpoints(spark):
    rows = [
        ("a", 30, 19.09, 72.86, 0.0), ("a", 10, 28.55, 77.1, None), ("a", 20, 23.0, 75.0, 9000.0),
        ("b", 10, 28.55, 77.1, 0.0),
        ("c", 10, 28.55, 77.1, 2000.0), ("c", 11, 60.0, 10.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "icao24 string, time bigint, lat double, lon double, baroaltitude double")
    got = {
        r.icao24: (r.origin_code, r.destination_code)
        for r in sites.track_endpoints(df, dims.airports(spark)).collect()
    }
    assert got == {"a": ("DEL", "BOM"), "b": (None, None), "c": (None, None)}


def test_track_distance_does_not_depend_on_the_buckets(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice("ab"), rng.randrange(0, 50_000), rng.uniform(-5, 5), rng.uniform(170, 180))
        for _ in range(400)
    ] + [("c", 5, 1.0, 1.0), ("d", 5, None, 1.0)]
    df = spark.createDataFrame(rows, "icao24 string, time bigint, lat double, lon double")
    expected = {}
    for key in "abc":
        points = sorted((t, la, lo) for k, t, la, lo in rows if k == key)
        steps = [km(p[1:], q[1:]) for p, q in zip(points, points[1:])]
        expected[key] = (pytest.approx(sum(steps)), len(points))
    for bucket in (60, 600, 10**9):
        got = tracks.track_distance(df, bucket_seconds=bucket).collect()
        assert {r.icao24: (r.distance_km, r.positions) for r in got} == expected


STATE = (
    "time bigint, icao24 string, lat double, lon double, velocity double, heading double, "
    "vertrate double, callsign string, onground boolean, alert boolean, spi boolean, "
    "squawk string, baroaltitude double, geoaltitude double, lastposupdate double, "
    "lastcontact double, departure_airport string, arrival_airport string, route string, "
    "aircraft_model string, aircraft_type string"
)


def state(t, v, ground, squawk="1", model="M", callsign="x1", **other):
    return (t, "a", other.get("lat", 1.0), 2.0, v, 3.0, other.get("rate", 0.0), callsign, ground,
            None, True, squawk, 4.0, 5.0, 6.0, 7.0, "A", "B", "A->B", model, "T")


def test_fact_of_one_report(spark):
    fact = star.fact_flight_history(spark.createDataFrame([state(1, 9.0, False)], STATE)).first()
    assert fact.stddev_velocity is None and fact.duration_seconds == 0
    assert (fact.airborne_percentage, fact.alert_count, fact.spi_count) == (100.0, 0, 1)


def test_fact_merges_details_of_one_flight(spark):
    speeds = [250.13, 249.87, None, 10.5, 250.13, 7.25]
    rows = [
        state(100 + 60 * i, v, i == 3, squawk=s, model=m, rate=5.0 if i == 5 else 0.5)
        for i, (v, s, m) in enumerate(zip(speeds, ["1", "2", None, "1", "3", "2"], "ZZABZZ"))
    ]
    fact = star.fact_flight_history(spark.createDataFrame(rows[::-1], STATE)).collect()
    assert len(fact) == 1
    known = [v for v in speeds if v is not None]
    mean = sum(known) / len(known)
    sd = math.sqrt(sum((v - mean) ** 2 for v in known) / (len(known) - 1))
    assert fact[0].stddev_velocity == pytest.approx(sd, rel=1e-12)
    assert fact[0].avg_velocity == pytest.approx(mean)
    assert fact[0].unique_squawk_codes == 3 and fact[0].total_data_points == 6
    assert fact[0].aircraft_model == "Z" and fact[0].duration_minutes == 5.0
    assert fact[0].airborne_percentage == pytest.approx(83.33)


def test_fact_equal_speeds_have_no_spread(spark):
    rows = [state(i, 231.4567, False, squawk=str(i % 7)) for i in range(100)]
    assert star.fact_flight_history(spark.createDataFrame(rows, STATE)).first().stddev_velocity < 1e-9


def test_utilization_last_position_and_callsigns(spark):
    rows = [
        state(50, 1.0, False, callsign="b", lat=5.0), state(10, 1.0, None, callsign=None, lat=6.0),
        state(60, 3.0, True, callsign="a", lat=7.0), state(60, 2.0, False, callsign="c", lat=8.0),
    ]
    got = star.dim_aircraft_utilization(spark.createDataFrame(rows, STATE)).first()
    assert (got.callsign, got.number_of_flights, got.airborne_data_points) == (None, 3, 2)
    assert got.last_reported_lat == 8.0 and got.avg_velocity == pytest.approx(7 / 4)
    assert got.estimated_flight_hours == 0.01


def test_heatmap_sketch_is_close(spark):
    rows = [state(i, 1.0, False)[:1] + (f"x{i}",) + state(i, 1.0, False)[2:] for i in range(500)]
    gold = spark.createDataFrame(rows, STATE)
    exact = star.dim_airspace_heatmap(gold).first()
    sketch = star.dim_airspace_heatmap(gold, approx=True).first()
    assert exact.traffic_density == 500 and abs(sketch.traffic_density - 500) < 50
    assert exact.geo_hash == "1.0,2.0"


def test_mapping_takes_one_whole_flight(spark):
    rows = [
        ("igo1 ", None, "VIDP", "VABB", "X", "m2", "t2", 5), ("IGO1", "EGLL", None, None, "VOMM", None, None, 1),
        ("IGO1", "VIDP", None, None, "VABB", "m2", "t2", 5), (" ", "A", "A", "B", "B", "m", "t", 1),
        ("IGO2", None, None, "B", "B", "m", "t", 1),
    ]
    df = spark.createDataFrame(
        rows,
        "callsign string, estdepartureairport string, airportofdeparture string, "
        "estarrivalairport string, airportofdestination string, model string, typecode string, "
        "firstseen bigint",
    )
    got = star.build_mapping(df).collect()
    assert [(r.callsign, r.route, r.aircraft_model, r.flight_count) for r in got] == [
        ("IGO1", "EGLL->VOMM", None, 3)
    ]


def test_match_rate_of_nothing(spark):
    got = star.match_rate(spark.createDataFrame([], "route string")).first()
    assert tuple(got) == (0, 0, 0.0)


def test_airport_stats_keep_departures_and_arrivals_apart(spark):
    rows = [("a", "DEL", "Delhi", "BOM", None)] * 5 + [("a", "BOM", "Mumbai", "DEL", "Delhi")] * 3
    rows += [(None, "GOI", "Goa", None, None)]
    df = spark.createDataFrame(
        rows,
        "icao24 string, origin_code string, origin_city string, destination_code string, "
        "destination_city string",
    )
    got = {(r.airport_code, r.city): (r.departures, r.arrivals, r.total_flights) for r in serving.airport_stats(df).collect()}
    assert got == {
        ("DEL", "Delhi"): (5, 3, 8), ("BOM", None): (0, 5, 5), ("BOM", "Mumbai"): (3, 0, 3),
        ("GOI", "Goa"): (0, 0, 0),
    }
    assert serving.airport_stats(df.select("icao24")) is None
    assert serving.airline_stats(df) is None and serving.hourly_stats(df) is None


def test_partials_merge_to_the_same_statistics(spark):
    rng = random.Random(1)
    rows = [
        (f"a{rng.randrange(9)}", rng.choice(["X", "Y", None]), rng.randrange(10**6),
         rng.choice([None, rng.uniform(0, 9)]), rng.uniform(0, 9))
        for _ in range(300)
    ]
    ddl = "icao24 string, airline_name string, last_contact bigint, baro_altitude double, velocity double"
    whole = spark.createDataFrame(rows, ddl)
    halves = [spark.createDataFrame(rows[:100], ddl), spark.createDataFrame(rows[100:], ddl)]
    for table in (serving.AIRLINE_STATS, serving.HOURLY_STATS, serving.FLIGHT_SUMMARY):
        merged = table.finish(table.partials(halves[0]).unionByName(table.partials(halves[1])))
        a, b = (sorted(map(tuple, x.collect()), key=str) for x in (merged, table.build(whole)))
        assert len(a) == len(b)
        for mine, other in zip(a, b):
            assert list(mine) == [pytest.approx(v) if isinstance(v, float) else v for v in other]


def test_latest_state_ignores_arrival_order(spark):
    rows = [("a", 3, 1, "late"), ("a", 5, 1, "x"), ("a", 5, 2, "last"), ("b", 1, 1, None), (None, 9, 9, "no")]
    df = spark.createDataFrame(rows, "icao24 string, time bigint, n int, v string")
    got = {r.icao24: r for r in live.accumulate(df, ties=("n",)).collect()}
    assert set(got) == {"a", "b"} and got["a"].v == "last"
    assert (got["a"].first_seen, got["a"].last_seen, got["a"].position_count) == (3, 5, 3)
    assert tuple(live.accumulator_totals(live.accumulate(df)).first()) == (4, 2, 2)


def test_live_figures(spark):
    rows = [("a", True, "India", "X", "DEL", "BOM"), ("b", None, None, "", "UNK", "BOM"),
            ("c", False, "India", None, None, "BOM"), ("d", False, "India", "X", "DEL", "BOM")]
    df = spark.createDataFrame(
        rows, "icao24 string, on_ground boolean, origin_country string, airline_name string, "
        "origin_code string, destination_code string")
    assert tuple(live.live_totals(df).first()) == (4, 3, 1)
    assert {tuple(r) for r in live.live_by_country(df).collect()} == {("India", 3), ("Unknown", 1)}
    assert [tuple(r) for r in live.live_by_airline(df).collect()] == [("X", 2)]
    assert [tuple(r) for r in live.live_top_routes(df).collect()] == [("DEL-BOM", 2)]


def test_dedup_takes_the_lowest_in_order_and_keeps_null_keys(spark):
    rows = [("a", None, 1, "old"), ("a", None, 2, "new"), ("a", "x", 1, "other")]
    df = spark.createDataFrame(rows, "icao24 string, callsign string, last_contact int, v string")
    got = merge.dedup(df, ["icao24", "callsign"], [-F.col("last_contact")])
    assert {tuple(r) for r in got.collect()} == {("a", None, 2, "new"), ("a", "x", 1, "other")}
    assert got.columns == df.columns


def test_merge_with_one_side_missing(spark):
    assert merge.merge_unified(None, None) is None and merge.merge_gold(None, None) is None


def test_sample_is_a_fraction_and_always_the_same(spark):
    df = spark.range(1000)
    take = lambda d, *a: sorted(r.id for r in merge.sample_fraction(d, *a).collect())
    half = take(df, 0.5, ["id"])
    assert 400 < len(half) < 600 and half == take(df.repartition(7), 0.5, ["id"])
    assert half != take(df, 0.5, ["id"], 7) and set(take(df, 0.25, ["id"])) < set(half)
    assert len(take(df, 1.0, ["id"])) == 1000 and take(df, 0.0, ["id"]) == []
    with pytest.raises(ValueError):
        merge.sample_fraction(df, 1.5, ["id"])


def test_reports_of_one_second_never_mix(spark):
    """Two reports a hair apart: whole rows by value, whatever the order of the input."""
    rows = [("a", 10**13, 28.5562, 77.1, 50.0, None), ("a", 10**13, 28.5563, 77.1, 9000.0, None),
            ("a", 10**13 + 5, 19.0896, 72.8656, 10.0, None), (None, 1, 0.0, 0.0, 0.0, None)]
    ddl = "icao24 string, time bigint, lat double, lon double, baroaltitude double, callsign string"
    got = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, ddl).coalesce(1)
        got.add(tuple(map(tuple, sites.track_endpoints(df, dims.airports(spark)).collect())))
    assert got == {(("a", 3, "DEL", "BOM"),)}


def test_fill_and_metadata(spark):
    df = spark.createDataFrame([(None, None, "ABC", None)], "airline_name string, airline_icao string, airline_prefix string, origin_code string")
    got = filters.with_processing_metadata(filters.fill_unknown(df)).first()
    assert (got.airline_name, got.airline_icao, got.origin_code, got.source) == ("Unknown", "ABC", "UNK", "speed_layer")
    assert got.processing_time is not None
