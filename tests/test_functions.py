import math

import pytest
from pyspark.sql import functions as F

from trackloom import functions as fn
from trackloom import reference_data as ref


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, first, joined, trailing",
    [
        ("IGO6135", 6135, 6135, "6135"),
        ("AB12C3", 12, 123, "3"),
        ("ABC", None, None, ""),
        ("X007", 7, 7, "007"),
        ("A99999999999", None, None, "99999999999"),
    ],
)
def test_flight_numbers(spark, text, first, joined, trailing):
    assert one(spark, fn.flight_number("c"), c=text) == first
    assert one(spark, fn.all_digits("c"), c=text) == joined
    assert one(spark, fn.trailing_digits("c"), c=text) == trailing


@pytest.mark.parametrize(
    "text, known, any_prefix",
    [("IGO12", "IGO", "IGO"), ("AXBX1", "AXB", "AXB"), ("XY1", None, "XY"), ("igo1", None, None)],
)
def test_prefixes(spark, text, known, any_prefix):
    assert one(spark, fn.known_prefix("c", ref.LIVE_PREFIXES), c=text) == known
    assert one(spark, fn.airline_prefix("c"), c=text) == any_prefix


@pytest.mark.parametrize("lat, inside", [(6.0, True), (37.0, True), (5.999, False)])
def test_box_edges(spark, lat, inside):
    assert one(spark, fn.in_bbox("lat", "lon", ref.REGION_BOX), lat=lat, lon=68.0) is inside


def test_short_prefix_matches_longer_code(spark):
    assert one(spark, fn.has_prefix("c", ref.REGION_PREFIXES), c="AIB1") is True


@pytest.mark.parametrize(
    "here, there, km",
    [
        ((0.0, 0.0), (0.0, 180.0), math.pi * 6371),
        ((90.0, 0.0), (-90.0, 0.0), math.pi * 6371),
        ((28.5562, 77.1), (28.5562, 77.1), 0.0),
        ((0.0, 179.5), (0.0, -179.5), math.pi * 6371 / 180),
    ],
)
def test_haversine(spark, here, there, km):
    got = one(spark, fn.haversine_km("a", "b", "c", "d"), a=here[0], b=here[1], c=there[0], d=there[1])
    assert got == pytest.approx(km, abs=1e-6)


def test_haversine_of_missing_point_is_null(spark):
    lat = F.lit(None).cast("double")
    assert spark.range(1).select(fn.haversine_km(lat, F.lit(1.0), F.lit(2.0), F.lit(3.0))).first()[0] is None


@pytest.mark.parametrize("there, degrees", [((1.0, 0.0), 0), ((0.0, 1.0), 90), ((-1.0, 0.0), 180), ((0.0, -1.0), 270)])
def test_bearing(spark, there, degrees):
    got = one(spark, fn.bearing_deg(F.lit(0.0), F.lit(0.0), "c", "d"), c=there[0], d=there[1])
    assert got == pytest.approx(degrees)


def test_flight_id_of_missing_callsign_is_the_date(spark):
    got = one(spark, fn.flight_id(fn.utc_date("t"), F.lit(None).cast("string")), t=1_704_067_200)
    assert got == "2024-01-01"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_dates_and_hours_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = fn.with_date_parts(
            spark.sql("select 1704153599 as time"), parts=("year", "month", "day", "hour")
        ).first()
        assert row[1:] == (2024, 1, 1, 23)
        assert str(spark.sql("select -1L as time").select(fn.utc_date("time")).first()[0]) == "1969-12-31"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lookback_with_and_without_end(spark):
    df = spark.range(0, 20).select((F.col("id") * 86_400).alias("time"))
    assert fn.lookback(df, days=7).count() == 8
    assert fn.lookback(df, days=7, until=10 * 86_400).count() == 17
