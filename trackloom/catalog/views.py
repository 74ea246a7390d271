"""The given tables in the shapes the operators work on.

Each view is one SQL text that runs in Spark and, with another epoch expression, in the
checking engine. Views keep every row of their table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import utc_date, utc_hour, with_date_parts
from ..operators.lookup import enrich_routes
from ..operators.star import build_mapping
from ..schemas import SPEED_STATES, names
from ..sources import dims
from ..streaming.enrich import enrich_flights

# seconds since 1970 of a timestamp without zone
SPARK_EPOCH = (
    "(cast(unix_date(cast({c} as date)) as bigint) * 86400"
    " + hour({c}) * 3600 + minute({c}) * 60 + cast(second({c}) as bigint))"
)
CHECK_EPOCH = "cast(floor(epoch({c})) as bigint)"

_CARRIER = (
    "case {u} % 6 when 0 then 'IGO' when 1 then 'AIC' when 2 then 'VTI' "
    "when 3 then 'SEJ' when 4 then 'AKJ' else 'ZZZ' end"
)

# Batch position reports. Call signs are missing, lower case or padded at times;
# latitude and squawk are missing at times.
TELEMETRY = f"""
select event_id,
       'a' || lpad(cast(user_id as varchar(20)), 5, '0') as icao24,
       t as time,
       case when event_id % 97 = 0 then null
            when event_id % 5 = 0 then lower(cs) || '  ' else cs end as callsign,
       case when event_id % 89 = 0 then null
            else 4.0e0 + cast((event_id * 7919) % 3600 as double) / 100 end as lat,
       66.0e0 + cast((event_id * 104729) % 3400 as double) / 100 as lon,
       value as velocity,
       cast((event_id * 31) % 360 as double) as heading,
       cast((event_id * 13) % 41 as double) - 20 as vertrate,
       cast((event_id * 31) % 12000 as double) as baroaltitude,
       cast((event_id * 37) % 12000 as double) as geoaltitude,
       event_type = 'signup' as onground, event_type = 'error' as alert,
       event_type = 'click' as spi,
       case when event_id % 11 = 0 then null
            else lpad(cast(event_id % 50 as varchar(20)), 4, '0') end as squawk,
       cast(t as double) as lastposupdate, cast(t as double) + 1 as lastcontact
from (select e.*, {{epoch}} as t, {_CARRIER.format(u='user_id')}
             || cast(100 + (user_id * 7 + (event_id % 2) * 11) % 900 as varchar(20)) as cs
      from {{events}} e) x
"""

# Flight history. Airports are missing at times; a tenth of the customers fly under call
# signs that no report carries.
HISTORY = f"""
select o_orderkey, cs as callsign,
       case when o_orderkey % 13 = 0 then null else dep end as estdepartureairport,
       case when o_orderkey % 26 = 0 then null else dep end as airportofdeparture,
       case when o_orderkey % 17 = 0 then null else arr end as estarrivalairport,
       arr as airportofdestination,
       o_orderpriority as model, o_orderstatus as typecode, {{epoch}} as firstseen
from (select o.*, ' ' || lower(case when o_custkey % 10 = 3 then 'QQQ'
                               else {_CARRIER.format(u='u')} end
             || cast(100 + (u * 7 + (o_orderkey % 2) * 11) % 900 as varchar(20))) as cs,
             case o_orderkey % 5 when 0 then 'VIDP' when 1 then 'VABB' when 2 then 'VOBL'
                                 when 3 then 'OMDB' else 'WSSS' end as dep,
             case o_custkey % 4 when 0 then 'VOMM' when 1 then 'VECC' when 2 then 'EGLL'
                                else 'OTHH' end as arr
      from (select *, o_custkey % 200 as u from {{orders}}) o) y
"""

# Live position reports.
LIVE = """
select event_id, icao24, callsign,
       case when event_id % 7 = 0 then null when event_id % 3 = 0 then 'India'
            else 'United Arab Emirates' end as origin_country,
       time as time_position, time + 1 as last_contact, lon as longitude, lat as latitude,
       case when event_id % 23 = 0 then 0.0e0 else baroaltitude end as baro_altitude,
       onground as on_ground, velocity, heading as true_track, vertrate as vertical_rate,
       cast(null as varchar(20)) as sensors, geoaltitude as geo_altitude, squawk, spi,
       cast(event_id % 3 as int) as position_source,
       cast(time + 2 as varchar(20)) as ingestion_time
from {telemetry} t
"""

# A published schedule with self loops, unknown carriers and missing ends.
SCHEDULE = """
select case o_custkey % 9 when 0 then '6E' when 1 then 'AI' when 2 then 'IX' when 3 then 'SG'
            when 4 then 'UK' when 5 then 'QP' when 6 then 'G8' when 7 then '9I' else 'ZZ' end
       || cast(100 + o_orderkey % 900 as varchar(20)) as "FlightNo",
       case o_orderkey % 5 when 0 then 'DEL' when 1 then 'BOM' when 2 then 'BLR'
            when 3 then 'XYZ' else null end as "Origin",
       case o_custkey % 4 when 0 then 'DEL' when 1 then 'CCU' when 2 then 'HYD'
            else 'COK' end as "Destination"
from {orders} o
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = TELEMETRY.replace("{epoch}", SPARK_EPOCH.format(c="ts"))
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = HISTORY.replace("{epoch}", SPARK_EPOCH.format(c="o_orderdate"))
    return spark.sql(sql, orders=table(spark, sf_dir, "orders"))


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LIVE, telemetry=telemetry(spark, sf_dir))


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = SCHEDULE.replace('"', "`")
    return spark.sql(sql, orders=table(spark, sf_dir, "orders"))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mapping(history(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, routes: DataFrame | None = None) -> DataFrame:
    """Batch reports with dates and routes; ``routes`` is the mapping if it is stored already."""
    states = with_date_parts(telemetry(spark, sf_dir))
    return enrich_routes(states, mapping(spark, sf_dir) if routes is None else routes)


def speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live reports with routes and tracking columns, in the stored layout."""
    flights = live(spark, sf_dir)
    enriched = enrich_flights(flights, dims.route_rules(spark), keep_unmatched=True)
    return enriched.withColumns(
        {
            "first_seen": F.col("time_position").cast("string"),
            "last_seen": F.col("last_contact").cast("string"),
            "position_count": (F.col("event_id") % 4 + 1).cast("int"),
        }
    ).select("event_id", *names(SPEED_STATES))


def speed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live layer as stored, with its partition columns."""
    stored = speed(spark, sf_dir)
    date = utc_date("last_contact")
    return stored.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "hour": utc_hour("last_contact"),
        }
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of task logs: one per report, and at a task's end the line that marks it."""
    report = telemetry(spark, sf_dir).select(
        F.format_string("dag%d", F.col("event_id") % 3).alias("dag_id"),
        F.format_string("run%d", F.floor(F.col("time") / 86_400)).alias("run_id"),
        F.when(F.col("event_id") % 7 < 3, "extract").otherwise("load").alias("task_id"),
        "event_id", "time", "alert", "spi",
    )
    kind = F.when(F.col("alert"), "Error in report ").when(F.col("spi"), "duration of report ").otherwise("report ")
    keys = ["dag_id", "run_id", "task_id"]

    def stamp(epoch):
        day, second = utc_date(epoch), F.pmod(epoch, F.lit(86_400))
        clock = [F.lpad((F.floor(second / n) % m).cast("string"), 2, "0") for n, m in ((3600, 24), (60, 60), (1, 60))]
        return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T"), *clock)

    ends = report.groupBy(*keys).agg(F.min("time").alias("a"), F.max("time").alias("b"))
    state = F.when(F.crc32(F.concat_ws("/", *keys).cast("binary")) % 3 == 0, "FAILED").otherwise("SUCCESS")
    mark = F.concat(
        F.lit("Marking task as "), state, F.lit(". dag_id="), "dag_id", F.lit(", task_id="), "task_id",
        F.lit(", start_date="), stamp(F.col("a")), F.lit(", end_date="), stamp(F.col("b")),
    )
    lines = report.select(*keys, F.col("event_id").alias("place"), F.concat(kind, F.col("event_id").cast("string")).alias("value"))
    return lines.unionByName(ends.select(*keys, F.lit(2**60).alias("place"), mark.alias("value")))
