"""SQL that gives the expected rows of the registered queries, written independently of them.

``CTES`` are named building blocks; ``CHECKS`` hold one final select per query. Only the
blocks that a query needs are put in front of it.
"""

import re

from .. import reference_data as ref
from ..operators.filters import TELEMETRY_COLUMNS
from ..schemas import LIVE_STATES, SPEED_STATES, STATES, names
from .views import CHECK_EPOCH, HISTORY, LIVE, SCHEDULE, TELEMETRY


def _values(name: str, columns: str, rows) -> str:
    def literal(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"{v!r}e0" if isinstance(v, float) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as {name}({columns})"


def _hybrid_airports():
    for code, name, city, lat, lon in ref.AIRPORTS:
        if code in ref.HYBRID_AIRPORT_CODES:
            yield (code, name, city, *ref.HYBRID_COORDINATES.get(code, (lat, lon)))


_AIRPORT = "code, name, city, lat, lon"
_LIVE_AIRPORTS = [a for a in ref.AIRPORTS if a[0] in ref.LIVE_AIRPORT_CODES]

# distance of (a.lat, a.lon) to (s.lat, s.lon)
KM = (
    "2 * 6371.0e0 * asin(sqrt(least(1.0e0, pow(sin(radians(s.lat - a.lat) / 2), 2)"
    " + cos(radians(a.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - a.lon) / 2), 2))))"
)
DATE = "cast(make_timestamp(cast({t} as bigint) * 1000000) as date)"
HOUR = "cast(hour(make_timestamp(cast({t} as bigint) * 1000000)) as int)"
CLEAN = "upper(trim({c}, ' '))"


def _parts(t: str) -> str:
    d = DATE.format(t=t)
    return (
        f"cast(year({d}) as int) as year, cast(month({d}) as int) as month, "
        f"cast(day({d}) as int) as day"
    )


def _known_prefix(c: str) -> str:
    return "case " + " ".join(f"when {c} like '{p}%' then '{p}'" for p in ref.LIVE_PREFIXES) + " end"


def _first_digits(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '([0-9]+)', 1), '') as int)"


def _half_up(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` of whole numbers, rounded half up, without binary ties."""
    scale = 10**digits
    return (
        f"(({numerator}) * {2 * scale} + ({denominator})) // (2 * ({denominator})) / {scale}.0e0"
    )


# order of reports: second, then position and altitude as they are
ORDER = "time, lat nulls first, lon nulls first, coalesce({alt}, 0)"

_END_COLUMNS = ", ".join(
    f"{a}.code as {end}_code, {a}.city as {end}_city, {a}.name as {end}_airport, "
    f"{a}.lat as {end}_lat, {a}.lon as {end}_lon"
    for end, a in (("origin", "o"), ("destination", "d"))
)

# crc32 of a text of ASCII signs, from a table that is made bit by bit
_CRC_TABLE = """
    select list(list_reduce(list_prepend(b, range(8)),
                            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as crcs
    from range(256) r(b)"""


def _crc(text: str) -> str:
    data = f"list_transform(string_split({text}, ''), lambda x: cast(ord(x) as bigint))"
    step = "xor(crcs[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: {step}), 4294967295)"


_STAMP = "strftime(make_timestamp(cast({t} as bigint) * 1000000), '%Y%m%dT%H%M%S')"

CTES = {
    "crc_table": _CRC_TABLE,
    "telemetry": TELEMETRY.replace("{epoch}", CHECK_EPOCH.format(c="ts")).replace("{events}", "events"),
    "routes_hist": HISTORY.replace("{epoch}", CHECK_EPOCH.format(c="o_orderdate")).replace(
        "{orders}", "orders"
    ),
    "live": LIVE.replace("{telemetry}", "telemetry"),
    "schedule": SCHEDULE.replace("{orders}", "orders"),
    "airlines": _values("t", "airline_icao, airline_name, airline_iata", ref.AIRLINES),
    "carriers": _values("t", "airline_iata, airline_name, airline_prefix", ref.SCHEDULE_CARRIERS),
    "airports": _values("t", _AIRPORT, ref.AIRPORTS),
    "live_airports": _values("t", _AIRPORT, _LIVE_AIRPORTS),
    "hybrid_airports": _values("t", _AIRPORT, _hybrid_airports()),
    "rules": _values(
        "t",
        "rule_rank, airline_prefix, min_flight_num, max_flight_num, origin_code, destination_code",
        [(i, *r) for i, r in enumerate(ref.NUMBER_RANGE_RULES)],
    ),
    "exact_routes": _values("t", "callsign, origin_code, destination_code", ref.EXACT_ROUTES),
    "valid": f"""
        select *, {CLEAN.format(c='callsign')} as cs,
               coalesce(estdepartureairport, airportofdeparture) as dep,
               coalesce(estarrivalairport, airportofdestination) as arr
        from routes_hist
        where {CLEAN.format(c='callsign')} <> ''
          and coalesce(estdepartureairport, airportofdeparture) is not null
          and coalesce(estarrivalairport, airportofdestination) is not null""",
    "mapping": """
        select cs as callsign, dep as departure_airport, arr as arrival_airport,
               model as aircraft_model, typecode as aircraft_type, flight_count,
               dep || '->' || arr as route
        from (select *, count(*) over (partition by cs) as flight_count,
                     row_number() over (partition by cs
                         order by firstseen, dep, arr, model, typecode) as rn
              from valid) where rn = 1""",
    "bronze": f"select *, {_parts('time')} from telemetry",
    "silver": f"""
        select b.*, departure_airport, arrival_airport, route, aircraft_model, aircraft_type
        from bronze b left join mapping m on {CLEAN.format(c='b.callsign')} = m.callsign""",
    "flights": f"""
        select *, {DATE.format(t='time')} as flight_date,
               {CLEAN.format(c='callsign')} as callsign_clean from silver""",
    "parts": f"""
        select * replace (trim(callsign, ' ') as callsign),
               {_known_prefix("trim(callsign, ' ')")} as airline_prefix,
               {_first_digits("trim(callsign, ' ')")} as flight_number
        from telemetry""",
    "live_parts": f"""
        select * replace (trim(callsign, ' ') as callsign),
               {_known_prefix("trim(callsign, ' ')")} as airline_prefix,
               {_first_digits("trim(callsign, ' ')")} as flight_number
        from live""",
    "rule_hits": """
        select p.event_id, p.airline_prefix, p.flight_number, r.rule_rank, r.origin_code,
               r.destination_code,
               row_number() over (partition by p.event_id order by r.rule_rank) as rn
        from live_parts p join rules r on p.airline_prefix = r.airline_prefix
         and p.flight_number between r.min_flight_num and r.max_flight_num""",
    "log_reports": """
        select 'dag' || (event_id % 3) as dag, 'run' || cast(floor(time / 86400) as bigint) as run,
               case when event_id % 7 < 3 then 'extract' else 'load' end as task, event_id, time,
               case when alert then 'Error in report ' when spi then 'duration of report ' else 'report ' end
               || event_id as line, alert or spi as important
        from telemetry""",
    "log_tasks": f"""
        select dag, run, task, min(time) as a, max(time) as b,
               {_crc("dag || '/' || run || '/' || task")} % 3 = 0 as failed
        from log_reports join crc_table on true group by dag, run, task, crcs""",
    "log_marks": f"""
        select dag, run, task, 'Marking task as ' || case when failed then 'FAILED' else 'SUCCESS' end
               || '. dag_id=' || dag || ', task_id=' || task || ', start_date=' || {_STAMP.format(t='a')}
               || ', end_date=' || {_STAMP.format(t='b')} as line from log_tasks""",
    "speed": f"""
        select l.*, c.airline_name, c.airline_iata, c.airline_icao, {_END_COLUMNS},
               cast(time_position as varchar) as first_seen,
               cast(last_contact as varchar) as last_seen,
               cast(l.event_id % 4 + 1 as int) as position_count
        from live_parts l
        left join rule_hits h on h.event_id = l.event_id and h.rn = 1
        left join airlines c on h.airline_prefix = c.airline_icao
        left join airports o on h.origin_code = o.code
        left join airports d on h.destination_code = d.code""",
    "speed_layer": f"""
        select *, {_parts('last_contact')}, {HOUR.format(t='last_contact')} as hour from speed""",
    "unified_batch": """
        select icao24, callsign, 'batch' as data_source, time as "timestamp",
               cast(lastcontact as bigint) as last_contact,
               cast(lastposupdate as bigint) as time_position, lat as latitude,
               lon as longitude, baroaltitude as baro_altitude, geoaltitude as geo_altitude,
               onground as on_ground, velocity, heading as true_track,
               vertrate as vertical_rate, squawk, spi, cast(null as int) as position_source,
               departure_airport as origin_code, cast(null as varchar) as origin_city,
               arrival_airport as destination_code, cast(null as varchar) as destination_city,
               route, aircraft_model, aircraft_type, cast(null as varchar) as airline_name,
               cast(null as varchar) as airline_icao, cast(null as varchar) as origin_country,
               year, month, day, cast(null as int) as hour,
               cast(null as varchar) as ingestion_time, cast(null as varchar) as first_seen,
               cast(null as varchar) as last_seen, 1 as position_count
        from silver""",
    "unified_speed": """
        select icao24, callsign, 'speed' as data_source, time_position as "timestamp",
               last_contact, time_position, latitude, longitude, baro_altitude, geo_altitude,
               on_ground, velocity, true_track, vertical_rate, squawk, spi, position_source,
               origin_code, origin_city, destination_code, destination_city,
               cast(null as varchar) as route, cast(null as varchar) as aircraft_model,
               cast(null as varchar) as aircraft_type, airline_name, airline_icao,
               origin_country, year, month, day, hour, ingestion_time, first_seen, last_seen,
               position_count
        from speed_layer""",
    "unified": "select * from unified_batch union all by name select * from unified_speed",
    "spread_year": f"""
        select *, {_parts('time')}
        from (select * replace (time + (event_id % 300) * 86400 as time) from telemetry)""",
    "gold_rows": f"""
        select icao24, {CLEAN.format(c='callsign')} as cs, lastcontact, time, {_parts('time')} from silver
        union all by name
        select icao24, {CLEAN.format(c='callsign')} as cs, cast(last_contact as double) as lastcontact,
               time_position as time, {_parts('time_position')} from speed_layer""",
    "gold_all": """
        select year, month, count(*) as states, cast(sum(time) as bigint) as seconds
        from gold_rows group by 1, 2""",
    "gold_once": """
        select year, month, count(*) as states, cast(sum(latest) as bigint) as seconds
        from (select icao24, cs, lastcontact, year, month, max(time) as latest
              from gold_rows group by all) group by 1, 2""",
    "coded": """
        select s."FlightNo" as flight_no, s."Origin" as origin_code,
               s."Destination" as destination_code, coalesce(c.airline_iata, 'XX') as airline_iata,
               coalesce(c.airline_name, 'Unknown') as airline_name,
               coalesce(c.airline_prefix, 'UNK') as airline_prefix,
               regexp_extract(s."FlightNo", '([0-9]+)$', 1) as num
        from schedule s
        left join carriers c on s."FlightNo" like c.airline_iata || '%'""",
    "schedule_one": """
        select * from (
            select *, airline_prefix || num as callsign,
                   row_number() over (partition by airline_prefix || num
                       order by flight_no, origin_code, destination_code) as rn
            from coded
            where origin_code is not null and destination_code is not null
              and origin_code <> destination_code) where rn = 1""",
    "schedule_routes": f"""
        select callsign, flight_no, airline_iata, airline_name, airline_prefix,
               airline_prefix as airline_icao, s.origin_code, s.destination_code,
               o.city as origin_city, o.name as origin_airport, o.lat as origin_lat,
               o.lon as origin_lon, d.city as destination_city, d.name as destination_airport,
               d.lat as destination_lat, d.lon as destination_lon
        from schedule_one s left join live_airports o on s.origin_code = o.code
        left join live_airports d on s.destination_code = d.code""",
    "primary_routes": """
        select callsign, origin_code, destination_code from (
            select airline_prefix || num as callsign, origin_code, destination_code,
                   row_number() over (partition by airline_prefix || num
                       order by flight_no desc, origin_code desc nulls last,
                                destination_code desc nulls last) as rn
            from coded) where rn = 1""",
    "near": f"""
        select a.event_id, s.code, {KM} as km,
               row_number() over (partition by a.event_id order by {KM}, s.code) as rn
        from telemetry a join live_airports s on a.lat is not null and {KM} <= 500""",
    "near_hybrid": f"""
        select a.event_id, s.code, {KM} as km,
               row_number() over (partition by a.event_id order by {KM}, s.code) as rn
        from telemetry a join hybrid_airports s on a.lat is not null and {KM} <= 500""",
    "hybrid_input": """
        select l.event_id, l.callsign, latitude, longitude, baro_altitude, geo_altitude, on_ground,
               coalesce(nullif(baro_altitude, 0), nullif(geo_altitude, 0)) as alt,
               upper(trim(l.callsign, ' ')) as cs,
               coalesce(p.origin_code, e.origin_code) as exact_o,
               coalesce(p.destination_code, e.destination_code) as exact_d,
               n1.code as c1, n1.km as km1, n2.code as c2, n2.km as km2
        from live l
        left join primary_routes p on upper(trim(l.callsign, ' ')) = p.callsign
        left join exact_routes e on upper(trim(l.callsign, ' ')) = e.callsign
             and p.callsign is null
        left join near_hybrid n1 on n1.event_id = l.event_id and n1.rn = 1
        left join near_hybrid n2 on n2.event_id = l.event_id and n2.rn = 2""",
    "hybrid": f"""
        select *, case when exact_o is not null and exact_d is not null then 'exact_database'
                       when latitude <> 0 and longitude <> 0 and alt > 1000 and km2 < 500
                            and not ((coalesce(on_ground, false) or coalesce(alt < 500, false))
                                     and km1 <= 15)
                       then 'geographic' end as method,
               {_known_prefix('cs')} as airline_prefix
        from hybrid_input""",
    "hybrid_route": """
        select *, case method when 'exact_database' then exact_o when 'geographic' then c1 end as oc,
               case method when 'exact_database' then exact_d when 'geographic' then c2 end as dc
        from hybrid""",
    "ends_ranked": f"""
        select icao24, lat, lon, coalesce(baroaltitude, 0) as alt,
               row_number() over (partition by icao24 order by {ORDER.format(alt='baroaltitude')}) as n,
               count(*) over (partition by icao24) as positions
        from telemetry""",
    "ends": """
        select icao24, positions,
               max(case when n = 1 then lat end) as flat, max(case when n = 1 then lon end) as flon,
               max(case when n = 1 then alt end) as falt,
               max(case when n = positions then lat end) as llat,
               max(case when n = positions then lon end) as llon,
               max(case when n = positions then alt end) as lalt
        from ends_ranked group by icao24, positions""",
    "end_points": """
        select icao24, 'o' as which, flat as lat, flon as lon from ends
        where positions >= 2 and falt < 1000
        union all
        select icao24, 'd', llat, llon from ends where positions >= 2 and lalt < 1000""",
    "end_sites": f"""
        select a.icao24, a.which, s.code,
               row_number() over (partition by a.icao24, a.which order by {KM}, s.code) as rn
        from end_points a join airports s on a.lat is not null and {KM} <= 300""",
    "trips": f"""
        select *, {CLEAN.format(c='callsign')} as cs, {DATE.format(t='time')} as d,
               coalesce(baroaltitude / 20, 0) as alt from telemetry""",
    "trips_ranked": f"""
        select cs, d, icao24, lat, lon, alt,
               row_number() over (partition by cs, d, icao24 order by {ORDER.format(alt='alt')}) as n,
               count(*) over (partition by cs, d, icao24) as positions
        from trips where cs <> ''""",
    "trip_ends": """
        select cs, d, icao24, positions,
               max(case when n = 1 then lat end) as flat, max(case when n = 1 then lon end) as flon,
               max(case when n = 1 then alt end) as falt,
               max(case when n = positions then lat end) as llat,
               max(case when n = positions then lon end) as llon,
               max(case when n = positions then alt end) as lalt
        from trips_ranked group by cs, d, icao24, positions""",
    "trip_points": """
        select cs, d, icao24, 'o' as which, flat as lat, flon as lon from trip_ends
        where positions >= 2 and falt < 1000
        union all
        select cs, d, icao24, 'd', llat, llon from trip_ends where positions >= 2 and lalt < 1000""",
    "trip_sites": f"""
        select a.cs, a.d, a.icao24, a.which, s.code,
               row_number() over (partition by a.cs, a.d, a.icao24, a.which
                                  order by {KM}, s.code) as rn
        from trip_points a join airports s on a.lat is not null and {KM} <= 800""",
    "trip_routes": """
        select o.cs, o.code as oc, d.code as dc, count(*) as n
        from trip_sites o join trip_sites d on o.cs = d.cs and o.d = d.d and o.icao24 = d.icao24
        where o.which = 'o' and d.which = 'd' and o.rn = 1 and d.rn = 1 group by all""",
    "hops": f"""
        select event_id, icao24, flight_date, callsign_clean, 1 as one,
               case when pd_lat is null then null else
               2 * 6371.0e0 * asin(sqrt(least(1.0e0, pow(sin(radians(lat - pd_lat) / 2), 2)
               + cos(radians(pd_lat)) * cos(radians(lat))
               * pow(sin(radians(lon - pd_lon) / 2), 2)))) end as day_km,
               case when pf_lat is null then null else
               2 * 6371.0e0 * asin(sqrt(least(1.0e0, pow(sin(radians(lat - pf_lat) / 2), 2)
               + cos(radians(pf_lat)) * cos(radians(lat))
               * pow(sin(radians(lon - pf_lon) / 2), 2)))) end as flight_km,
               case when pr_lat is null then null else
               2 * 6371.0e0 * asin(sqrt(least(1.0e0, pow(sin(radians(lat - pr_lat) / 2), 2)
               + cos(radians(pr_lat)) * cos(radians(lat))
               * pow(sin(radians(lon - pr_lon) / 2), 2)))) end as route_km
        from (select *, lag(lat) over wd as pd_lat, lag(lon) over wd as pd_lon,
                     lag(lat) over wf as pf_lat, lag(lon) over wf as pf_lon,
                     lag(lat) over wr as pr_lat, lag(lon) over wr as pr_lon
              from flights where lat is not null
              window wd as (partition by icao24, flight_date order by time, lat, lon),
                     wf as (partition by icao24, flight_date, callsign_clean
                            order by time, lat, lon),
                     wr as (partition by icao24, flight_date, callsign_clean,
                                         departure_airport, arrival_airport, route
                            order by time, lat, lon)) x""",
    "fact": f"""
        select concat_ws('_', cast(flight_date as varchar), callsign_clean) as flight_id,
               flight_date, callsign_clean, icao24, departure_airport, arrival_airport, route,
               min(time) as first_seen, max(time) as last_seen,
               min(lastposupdate) as first_position_update,
               max(lastposupdate) as last_position_update,
               min(lastcontact) as first_contact, max(lastcontact) as last_contact,
               max(velocity) as max_velocity, min(velocity) as min_velocity,
               avg(velocity) as avg_velocity, stddev_samp(velocity) as stddev_velocity,
               max(baroaltitude) as max_baro_altitude, min(baroaltitude) as min_baro_altitude,
               avg(baroaltitude) as avg_baro_altitude, max(geoaltitude) as max_geo_altitude,
               min(geoaltitude) as min_geo_altitude, avg(geoaltitude) as avg_geo_altitude,
               avg(baroaltitude) filter (where abs(vertrate) < 1) as avg_cruise_altitude,
               max(vertrate) as max_vertical_rate, min(vertrate) as min_vertical_rate,
               avg(vertrate) as avg_vertical_rate, avg(heading) as avg_heading,
               min(lat) as min_latitude, max(lat) as max_latitude, avg(lat) as avg_latitude,
               min(lon) as min_longitude, max(lon) as max_longitude, avg(lon) as avg_longitude,
               count(*) filter (where onground) as onground_count,
               count(*) filter (where alert) as alert_count,
               count(*) filter (where spi) as spi_count,
               first(aircraft_model order by time) as aircraft_model,
               first(aircraft_type order by time) as aircraft_type,
               count(*) as total_data_points, count(distinct squawk) as unique_squawk_codes,
               max(time) - min(time) as duration_seconds,
               {_half_up('max(time) - min(time)', '60', 2)} as duration_minutes,
               {_half_up('max(time) - min(time)', '3600', 2)} as duration_hours,
               {_half_up('(count(*) - count(*) filter (where onground)) * 100', 'count(*)', 2)}
                   as airborne_percentage,
               case when count(lat) > 0 then round(coalesce(sum(route_km), 0), 6) end as distance_km
        from (select f.*, h.route_km from flights f left join hops h on h.event_id = f.event_id)
        group by flight_date, callsign_clean, icao24, departure_airport, arrival_airport, route""",
    "latest_live": """
        select * from (select *, row_number() over (partition by icao24
                           order by last_contact desc, event_id desc) as rn,
                           count(*) over (partition by icao24) as n from speed) where rn = 1""",
    "gridded": f"""
        select *, round(lat / 0.5e0) * 0.5e0 as lat_bin, round(lon / 0.5e0) * 0.5e0 as lon_bin,
               {HOUR.format(t='time')} as hour_of_day, {DATE.format(t='time')} as flight_date,
               {CLEAN.format(c='callsign')} as callsign_clean
        from telemetry""",
}

_STATES = ", ".join(names(STATES))
_LIVE_NO_SENSORS = ", ".join(
    n for n in names(LIVE_STATES) if n not in ("sensors", "ingestion_time")
)
_SPEED_OUT = ", ".join(
    n for n in names(SPEED_STATES)
    if n not in ("sensors", "first_seen", "last_seen", "position_count")
)
_PREFIX_TEST = " or ".join(
    f"{CLEAN.format(c='callsign')} like '{p}%'" for p in ref.REGION_PREFIXES
)
_BOX_TEST = "lat between 6.0 and 37.0 and lon between 68.0 and 98.0"
CTES["kept_silver"] = f"select * from silver where ({_BOX_TEST}) or ({_PREFIX_TEST})"
CTES["matched_speed"] = "select * from speed where origin_code is not null and destination_code is not null"
_ROUTE = "departure_airport, arrival_airport, route, aircraft_model, aircraft_type"

_LATEST = """
    select {extra} * exclude (rn)
    from (select *, row_number() over (partition by {keys} order by time desc, event_id desc) as rn,
                 min(time) over (partition by {keys}) as first_seen,
                 max(time) over (partition by {keys}) as last_seen,
                 count(*) over (partition by {keys}) as position_count
          from telemetry) where rn = 1"""

_SERVING_MEANS = "avg(baro_altitude) as avg_altitude, avg(velocity) as avg_velocity"

_BRONZE = f"select {_STATES}, year, month, day from bronze where ({_BOX_TEST}) or ({_PREFIX_TEST})"
_HOURLY = _LATEST.format(
    keys="icao24, floor(time / 3600)",
    extra="cast(floor(time / 3600) * 3600 as bigint) as hour_start,",
)
#: the star tables, built at once or load by load
_STAR = {
    "fact_flight_history": "select * from fact",
    "dim_route_analytics": """
        select coalesce(route, concat_ws('-', departure_airport, arrival_airport)) as route_id,
               departure_airport, arrival_airport,
               avg(duration_minutes) as avg_flight_time_minutes,
               avg(max_velocity) as avg_max_velocity,
               avg(avg_cruise_altitude) as avg_cruise_altitude, count(*) as total_flights,
               count(distinct callsign_clean) as unique_callsigns,
               sum(onground_count) * 100.0e0 / sum(total_data_points) as onground_pct
        from fact group by 1, 2, 3""",
    "dim_aircraft_utilization": f"""
        select icao24, flight_date, first(callsign order by time, callsign nulls first) as callsign,
               count(*) filter (where not onground) as airborne_data_points,
               count(distinct callsign) as number_of_flights,
               max(vertrate) as max_vertical_rate, min(vertrate) as min_vertical_rate,
               last(lat order by time, lat nulls first, lon nulls first) as last_reported_lat,
               last(lon order by time, lat nulls first, lon nulls first) as last_reported_lon,
               avg(velocity) as avg_velocity, max(baroaltitude) as max_altitude,
               {_half_up('count(*) filter (where not onground) * 10', '3600', 2)}
                   as estimated_flight_hours,
               case when count(lat) > 0 then round(coalesce(sum(day_km), 0), 6) end as distance_km
        from (select f.*, h.day_km from flights f left join hops h on h.event_id = f.event_id)
        group by icao24, flight_date""",
    "dim_airspace_heatmap": """
        select concat_ws(',', cast(lat_bin as varchar), cast(lon_bin as varchar)) as geo_hash,
               lat_bin, lon_bin, hour_of_day, count(distinct icao24) as traffic_density,
               avg(baroaltitude) as avg_altitude, stddev_samp(velocity) as velocity_variance,
               avg(velocity) as avg_velocity, count(*) as data_points
        from gridded group by lat_bin, lon_bin, hour_of_day""",
    "raw_telemetry": f"""
        select {', '.join('"timestamp"' if c == 'timestamp' else c for c in TELEMETRY_COLUMNS)}
        from (select *, make_timestamp(time * 1000000) as "timestamp",
                     {HOUR.format(t='time')} as hour_of_day from flights)""",
}
#: keys of the tables that are built load by load
_LOADED = {
    "fact_flight_history": "star_two_loads", "dim_route_analytics": "routes_two_loads",
    "dim_aircraft_utilization": "aircraft_two_loads", "dim_airspace_heatmap": "heatmap_two_loads",
    "raw_telemetry": "telemetry_two_loads",
}

CHECKS = {
    "scan_parquet": f"select {_STATES}, year, month, day from spread_year where month between 3 and 8",
    "scan_states_csv": f"select {_STATES} from telemetry",
    "scan_history_csv": "select * from routes_hist",
    "bronze_states": _BRONZE,
    "bronze_two_loads": _BRONZE,
    "silver_states": "select * from silver",
    "new_files_anti": """
        select cast(o_orderkey as varchar) as path, o_custkey as length
        from orders where o_orderstatus <> 'F'""",
    "ledger_upsert": """
        select file_path, layer, file_size_bytes, record_count from (
            select *, row_number() over (partition by file_path order by layer desc) as rn from (
                select cast(o_custkey as varchar) as file_path,
                       case when o_orderstatus = 'F' then 'batch' else 'speed' end as layer,
                       max(o_orderkey) as file_size_bytes, count(*) as record_count
                from orders group by 1, 2)) where rn = 1""",
    "india_routes_export": "select * from mapping where departure_airport like 'V%' or arrival_airport like 'V%'",
    "rules_table": """
        select r.*, coalesce(n, 0) as reports from rules r left join (
            select rule_rank, count(*) as n from rule_hits group by 1) using (rule_rank)""",
    "route_schedule": "select * from schedule_routes",
    "route_schedule_known": """
        select callsign, origin_code, destination_code from schedule_one
        where airline_prefix <> 'UNK' and num <> ''""",
    "state_vectors": f"select {_LIVE_NO_SENSORS}, 'now' as ingestion_time from live",
    "json_props": """
        select cast(json_extract(props, '$.k') as bigint) as k, count(*) as n
        from events group by 1""",
    "clean_callsign": f"select event_id, {CLEAN.format(c='callsign')} as callsign_clean from telemetry",
    "bbox_filter": f"select event_id, lat, lon from telemetry where {_BOX_TEST}",
    "prefix_filter": f"""
        select event_id, {CLEAN.format(c='callsign')} as callsign_clean from telemetry
        where {_PREFIX_TEST}""",
    "region_filter": f"select * from bronze where ({_BOX_TEST}) or ({_PREFIX_TEST})",
    "date_parts": f"select event_id, year, month, day, {HOUR.format(t='time')} as hour from bronze",
    "coalesce_airports": """
        select o_orderkey, coalesce(estdepartureairport, airportofdeparture) as dep_airport,
               coalesce(estarrivalairport, airportofdestination) as arr_airport from routes_hist""",
    "valid_routes": """
        select o_orderkey, cs as callsign_clean, dep as dep_airport, arr as arr_airport
        from valid""",
    "region_routes": "select * from mapping where departure_airport like 'V%' or arrival_airport like 'V%'",
    "route_text": """
        select o_orderkey, estdepartureairport || '->' || estarrivalairport as route,
               concat_ws('-', estdepartureairport, estarrivalairport) as route_id
        from routes_hist""",
    "airline_codes": "select flight_no, airline_iata, airline_name, airline_prefix from coded",
    "flight_number": f"""
        select event_id, {_first_digits("callsign || 'C3'")} as first_run,
               try_cast(nullif(regexp_replace(callsign || 'C3', '[^0-9]', '', 'g'), '') as int)
                   as all_digits,
               regexp_extract(callsign || 'C3', '([0-9]+)$', 1) as trailing,
               {_first_digits('icao24')} as of_icao24
        from telemetry""",
    "make_callsign": "select flight_no, airline_prefix || num as callsign from coded",
    "airline_prefix": f"""
        select event_id, {_known_prefix("trim(callsign, ' ')")} as known_prefix,
               nullif(regexp_extract(trim(callsign, ' '), '^([A-Z]{{2,3}})', 1), '') as any_prefix
        from telemetry""",
    "airport_attrs": """
        select "FlightNo" as flight_no, "Origin" as origin_code, "Destination" as destination_code,
               o.city as origin_city, o.name as origin_airport, o.lat as origin_lat,
               o.lon as origin_lon, d.city as destination_city, d.name as destination_airport,
               d.lat as destination_lat, d.lon as destination_lon
        from schedule s left join airports o on s."Origin" = o.code
        left join airports d on s."Destination" = d.code""",
    "default_fill": """
        select event_id, coalesce(airline_name, 'Unknown') as airline_name,
               coalesce(airline_iata, '--') as airline_iata,
               coalesce(airline_icao, airline_prefix) as airline_icao, airline_prefix,
               coalesce(origin_code, 'UNK') as origin_code,
               coalesce(origin_city, 'Unknown') as origin_city,
               coalesce(destination_code, 'UNK') as destination_code,
               coalesce(destination_city, 'Unknown') as destination_city from speed""",
    "normalize_batch": "select * from unified_batch",
    "normalize_speed": "select * from unified_speed",
    "flight_id": f"""
        select event_id, concat_ws('_', cast({DATE.format(t='time')} as varchar),
               {CLEAN.format(c='callsign')}) as flight_id from telemetry""",
    "grid_bin": """
        select event_id, lat_bin, lon_bin,
               concat_ws(',', cast(lat_bin as varchar), cast(lon_bin as varchar)) as geo_hash
        from gridded""",
    "flight_durations": f"""
        select icao24, min(time) as first_seen, max(time) as last_seen,
               count(*) filter (where onground) as onground_count, count(*) as total_data_points,
               max(time) - min(time) as duration_seconds,
               {_half_up('max(time) - min(time)', '60', 2)} as duration_minutes,
               {_half_up('max(time) - min(time)', '3600', 2)} as duration_hours,
               {_half_up('(count(*) - count(*) filter (where onground)) * 100', 'count(*)', 2)}
                   as airborne_percentage
        from telemetry group by icao24""",
    "hourly_ts": f"""
        select event_id, cast(lastcontact as bigint) as last_contact,
               {DATE.format(t='lastcontact')} as date, {HOUR.format(t='lastcontact')} as hour
        from telemetry""",
    "lookback_days": """
        select event_id, time from telemetry
        where time >= (select max(time) - 7 * 86400 from telemetry)""",
    "haversine": f"""
        select a.event_id, case when a.lat is not null then round({KM}, 6) end as km
        from telemetry a, (select 28.5562e0 as lat, 77.1e0 as lon) s""",
    "bearing": """
        select event_id, round(((degrees(atan2(
                   sin(radians(77.1e0 - lon)) * cos(radians(28.5562e0)),
                   cos(radians(lat)) * sin(radians(28.5562e0))
                   - sin(radians(lat)) * cos(radians(28.5562e0)) * cos(radians(77.1e0 - lon))))
               + 360.0e0) % 360.0e0), 6) as degrees
        from telemetry""",
    "interpolate": """
        select event_id, round(lat + (28.5562e0 - lat) * (heading / 360), 9) as lat,
               round(lon + (77.1e0 - lon) * (heading / 360), 9) as lon from telemetry""",
    "enrich_routes": f"""
        select t.*, {_ROUTE} from telemetry t
        left join mapping m on {CLEAN.format(c='t.callsign')} = m.callsign""",
    "enrich_exact": """
        select p.*, r.airline_iata, r.airline_name, r.airline_icao, r.origin_code,
               r.destination_code, r.origin_city, r.origin_airport, r.origin_lat, r.origin_lon,
               r.destination_city, r.destination_airport, r.destination_lat, r.destination_lon
        from parts p join schedule_routes r on p.callsign = r.callsign""",
    "enrich_callsign": f"""
        select event_id, callsign, airline_icao as airline_prefix, num as flight_number,
               origin_code, destination_code, airline_name, airline_iata, airline_icao
        from (select t.event_id, t.callsign, n.num, a.*, r.origin_code, r.destination_code,
                     row_number() over (partition by t.event_id order by r.rule_rank) as rn
              from telemetry t
              left join (select event_id as id, try_cast(nullif(regexp_replace(
                             callsign, '[^0-9]', '', 'g'), '') as int) as num from telemetry) n
                on t.event_id = n.id
              left join airlines a
                on substr({CLEAN.format(c='t.callsign')}, 1, 3) = a.airline_icao
              left join rules r
                on substr({CLEAN.format(c='t.callsign')}, 1, 3) = r.airline_prefix
               and n.num between r.min_flight_num and r.max_flight_num) where rn = 1""",
    "enrich_range_all": """
        select event_id, airline_prefix, flight_number, rule_rank, origin_code, destination_code
        from rule_hits""",
    "enrich_range_first": """
        select event_id, airline_prefix, flight_number, rule_rank, origin_code, destination_code
        from rule_hits where rn = 1""",
    "lookup_priority": f"""
        select t.event_id, t.callsign, coalesce(p.origin_code, e.origin_code) as origin_code,
               coalesce(p.destination_code, e.destination_code) as destination_code
        from telemetry t left join primary_routes p on {CLEAN.format(c='t.callsign')} = p.callsign
        left join exact_routes e on {CLEAN.format(c='t.callsign')} = e.callsign
             and p.callsign is null""",
    "nearest_site": """
        select t.event_id, t.lat, t.lon, n.code as site_code, round(n.km, 6) as site_km
        from telemetry t left join near n on n.event_id = t.event_id and n.rn = 1""",
    "nearest_site_default": f"""
        select t.event_id, n.code as site_code from telemetry t left join (
            select a.event_id, s.code,
                   row_number() over (partition by a.event_id order by {KM}, s.code) as rn
            from telemetry a join airports s on a.lat is not null and {KM} <= 50) n
        on n.event_id = t.event_id and n.rn = 1""",
    "two_nearest": """
        select t.event_id, n1.code as first_site, n2.code as second_site
        from telemetry t
        left join near n2 on n2.event_id = t.event_id and n2.rn = 2
             and t.baroaltitude > 5000 and t.velocity > 50
        left join near n1 on n1.event_id = n2.event_id and n1.rn = 1""",
    "route_from_position": """
        select event_id,
               case when at_site or cruising then c1 end as origin_code,
               case when cruising and not at_site then c2 end as destination_code,
               case when at_site or cruising then 'low' else 'none' end as confidence
        from (select t.event_id, n1.code as c1, n2.code as c2,
                     coalesce((onground or baroaltitude < 1000) and n1.km <= 20, false) as at_site,
                     coalesce(baroaltitude > 5000 and velocity > 50 and n2.code is not null, false)
                         as cruising
              from telemetry t
              left join near n1 on n1.event_id = t.event_id and n1.rn = 1
              left join near n2 on n2.event_id = t.event_id and n2.rn = 2)""",
    "enrich_hybrid": """
        select h.event_id, h.callsign, latitude, longitude, baro_altitude, geo_altitude, on_ground,
               airline_prefix, method as route_detection_method, oc as origin_code,
               dc as destination_code,
               case when method is not null then coalesce(o.city, '') end as origin_city,
               case when method is not null then coalesce(o.name, '') end as origin_airport,
               o.lat as origin_lat, o.lon as origin_lon,
               case when method is not null then coalesce(d.city, '') end as destination_city,
               case when method is not null then coalesce(d.name, '') end as destination_airport,
               d.lat as destination_lat, d.lon as destination_lon,
               case when method is not null then c.airline_name end as airline_name,
               case when method is not null then c.airline_iata end as airline_iata,
               case when method is not null then c.airline_icao end as airline_icao
        from hybrid_route h left join hybrid_airports o on oc = o.code
        left join hybrid_airports d on dc = d.code
        left join airlines c on h.airline_prefix = c.airline_icao""",
    "track_endpoints": """
        select e.icao24, positions, o.code as origin_code, d.code as destination_code from ends e
        left join end_sites o on o.icao24 = e.icao24 and o.which = 'o' and o.rn = 1
        left join end_sites d on d.icao24 = e.icao24 and d.which = 'd' and d.rn = 1""",
    "infer_routes": """
        select cs as callsign, oc as origin_code, dc as destination_code, n as flights
        from (select *, row_number() over (partition by cs order by n desc, oc, dc) as rn
              from trip_routes) where rn = 1""",
    "track_distance": """
        select icao24, flight_date, round(coalesce(sum(day_km), 0), 6) as distance_km,
               count(*) as positions from hops group by icao24, flight_date""",
    "flight_distance": """
        select flight_date, callsign_clean, icao24,
               round(coalesce(sum(flight_km), 0), 6) as distance_km, count(*) as positions
        from hops group by flight_date, callsign_clean, icao24""",
    "build_mapping": "select * from mapping",
    **_STAR,
    "cell_flights": """
        select lat_bin, lon_bin,
               count(distinct concat_ws('_', cast(flight_date as varchar), callsign_clean)) as flights,
               count(distinct icao24) as aircraft, count(*) as data_points
        from gridded group by lat_bin, lon_bin""",
    "route_onground_pct": """
        select departure_airport, arrival_airport, route,
               count(*) filter (where onground) as onground_points, count(*) as data_points,
               count(*) filter (where onground) * 100.0e0 / count(*) as onground_pct
        from silver group by 1, 2, 3""",
    "cruise_altitude": """
        select icao24, avg(baroaltitude) filter (where abs(vertrate) < 1) as avg_cruise_altitude,
               count(*) filter (where onground) as onground_count,
               count(*) filter (where alert) as alert_count
        from telemetry group by icao24""",
    "match_rate": f"""
        select count(*) as records, count(route) as matched,
               {_half_up('count(route) * 100', 'count(*)', 1)} as match_rate from silver""",
    "flight_summary": f"""
        select icao24, callsign, origin_country, count(*) as position_updates,
               min(first_seen) as first_seen, max(last_seen) as last_seen,
               max(baro_altitude) as max_altitude, max(velocity) as max_velocity,
               max(airline_name) as airline_name, max(origin_code) as origin_code,
               max(destination_code) as destination_code, {_SERVING_MEANS}
        from unified group by 1, 2, 3""",
    "flight_summary_batch": """
        select icao24, callsign, count(*) as position_updates, max(velocity) as max_velocity,
               avg(velocity) as avg_velocity from telemetry group by 1, 2""",
    "airline_stats": f"""
        select airline_name, count(icao24) as total_flights, {_SERVING_MEANS}
        from unified where airline_name is not null group by 1""",
    "airport_stats": """
        select airport_code, city, cast(sum(dep) as bigint) as departures,
               cast(sum(arr) as bigint) as arrivals,
               cast(sum(dep) + sum(arr) as bigint) as total_flights
        from (select origin_code as airport_code, max(origin_city) as city,
                     count(icao24) as dep, 0 as arr
              from unified where origin_code is not null group by 1
              union all
              select destination_code, max(destination_city), 0, count(icao24)
              from unified where destination_code is not null group by 1)
        group by 1, 2""",
    "hourly_stats": f"""
        select {DATE.format(t='last_contact')} as date, {HOUR.format(t='last_contact')} as hour,
               count(icao24) as total_flights, {_SERVING_MEANS}
        from unified group by 1, 2""",
    "latest_state": _LATEST.format(keys="icao24", extra=""),
    "live_totals": """
        select count(*) as total, count(*) - count(*) filter (where on_ground) as in_air,
               count(*) filter (where on_ground) as on_ground from latest_live""",
    "live_accumulator": """
        select cast(sum(n) as bigint) as total_messages, cast(sum(n - 1) as bigint) as updates,
               count(*) as new_flights from latest_live""",
    "live_by_country": """
        select coalesce(origin_country, 'Unknown') as country, count(*) as flights
        from latest_live group by 1""",
    "live_by_airline": """
        select airline_name, count(*) as flights from latest_live
        where airline_name <> '' group by 1""",
    "live_top_routes": """
        select origin_code || '-' || destination_code as route, count(*) as flights
        from latest_live where origin_code <> 'UNK' and destination_code <> ''
        group by 1 order by flights desc, route limit 10""",
    "merge_unified": "select * from unified",
    "merge_gold": f"""
        select 'batch' as data_source, {_STATES}, {_ROUTE}, cast(null as varchar) as origin_city
        from silver
        union all by name
        select 'speed' as data_source, time_position as time, icao24, latitude as lat,
               longitude as lon, velocity, true_track as heading, vertical_rate as vertrate,
               callsign, on_ground as onground, cast(null as boolean) as alert, spi, squawk,
               baro_altitude as baroaltitude, geo_altitude as geoaltitude,
               cast(time_position as double) as lastposupdate,
               cast(last_contact as double) as lastcontact, origin_code as departure_airport,
               destination_code as arrival_airport, origin_code || '->' || destination_code as route,
               cast(null as varchar) as aircraft_model, cast(null as varchar) as aircraft_type,
               origin_city
        from speed_layer""",
    "dedup_states": f"""
        select event_id, icao24, callsign, last_contact, time, lat, lon from (
            select event_id, icao24, {CLEAN.format(c='callsign')} as callsign,
                   cast(floor(time / 3600) as bigint) as last_contact, time, lat, lon,
                   row_number() over (
                       partition by icao24, {CLEAN.format(c='callsign')}, floor(time / 3600)
                       order by time desc, event_id desc) as rn
            from telemetry) where rn = 1""",
    "first_states": f"""
        select event_id, icao24, callsign, time from (
            select event_id, icao24, {CLEAN.format(c='callsign')} as callsign, time,
                   row_number() over (partition by icao24, {CLEAN.format(c='callsign')}
                                      order by time, event_id) as rn
            from telemetry) where rn = 1""",
    "top_reports": """
        select event_id, icao24, velocity, cast(rn as int) as rank from (
            select *, row_number() over (partition by icao24
                          order by velocity desc nulls last, event_id) as rn
            from telemetry) where rn <= 3""",
    "sample_rows": """
        select * from telemetry
        where substr(md5('42|' || cast(event_id as varchar)), 1, 8) < '80000000'""",
    "sample_bytes": """
        select * from telemetry
        where substr(md5('42|' || icao24), 1, 8) < '40000000'""",
    "gold_layers": f"""
        select 'full' as load, * from gold_all
        union all by name select 'incremental' as load, * from gold_all
        union all by name select 'distinct' as load, * from gold_once
        union all by name select 'distinct incremental' as load, * from gold_once""",
    "gold_window": f"""
        select data_source, cast(year({DATE.format(t='day')}) as int) as year, cast(month({DATE.format(t='day')}) as int) as month,
               count(*) as states, cast(sum(t) as bigint) as seconds
        from (select *, max(t) over () - 60 * 86400 as cut from (
            select 'batch' as data_source, time + event_id % 300 * 86400 as t, time + event_id % 300 * 86400 as day
            from telemetry
            union all
            select 'speed', time_position + 330 * 86400, last_contact + 330 * 86400 from speed))
        where t >= cut group by 1, 2, 3""",
    "serving_two_loads": f"""
        select airline_name, count(icao24) as total_flights, {_SERVING_MEANS},
               (select count(*) from unified) as stored_states, true as ledger_unique
        from unified where airline_name is not null group by 1""",
    "mapping_job_rows": "select * from mapping",
    "star_tables": """
        select 'fact_flight_history' as name, count(*) as n, sum(total_data_points) as total from fact
        union all select 'raw_telemetry', count(*), sum(time) from telemetry""",
    **{key: _STAR[table] for table, key in _LOADED.items()},
    "stream_enrich": f"select {_SPEED_OUT} from speed where origin_code is not null and destination_code is not null",
    "scan_states_tar": f"select {_STATES} from telemetry",
    "source_files": "select day as source_day, count(*) as rows from bronze group by 1",
    "log_rows": """
        select dag, run, task, line from log_reports union all select dag, run, task, line from log_marks""",
    "task_figures": """
        select dag, run, count(*) as tasks, count(*) filter (where not failed) as successful_tasks,
               count(*) filter (where failed) as failed_tasks, cast(sum(b - a) as bigint) as total_task_seconds,
               max(b) - min(a) as wall_seconds, sum(b - a) / cast(count(*) as double) as mean_task_seconds,
               case when max(b) > min(a) then sum(b - a) * 100 / cast(max(b) - min(a) as double) end as efficiency_pct
        from log_tasks group by dag, run""",
    "log_tail": """
        select dag, run, task, important_lines, from_end, line from (
            select *, count(*) over (partition by dag, run, task) as important_lines,
                   cast(row_number() over (partition by dag, run, task order by place desc) as int) as from_end
            from (select dag, run, task, event_id as place, line from log_reports where important
                  union all select dag, run, task, 1000000000000000, line from log_marks)) where from_end <= 5""",
    "storage_figures": """
        select 'by_day' as layer, count(distinct day) as files, true as has_bytes from bronze
        union all select 'in_parts', 4, true
        union all select 'folders of by_day', count(distinct day), true from bronze""",
    "job_figures": f"""
        select 'mapping' as job, 'total_records' as figure, cast(count(*) as double) as value from routes_hist
        union all select 'mapping', 'unique_callsigns', count(*) from mapping
        union all select 'mapping', 'valid_records', sum(flight_count) from mapping
        union all select 'mapping', 'region_routes', count(*) from mapping
            where departure_airport like 'V%' or arrival_airport like 'V%'
        union all select 'bronze', 'records', count(*) from kept_silver
        union all select 'bronze', 'broken_archives', 0
        union all select 'silver', 'records', count(*) from kept_silver
        union all select 'silver', 'matched', count(route) from kept_silver
        union all select 'silver', 'match_rate', {_half_up('count(route) * 100', 'count(*)', 1)} from kept_silver
        union all select 'gold', 'gold_records', count(*) from kept_silver""",
    "processing_metadata": "select 'speed_layer' as source, true as is_fresh, count(*) as rows from telemetry",
    "live_tables": """
        select 'enrichment' as "table", count(*) as rows, count(*) as reports from matched_speed
        union all select 'state', count(distinct icao24), count(*) from matched_speed
        union all select 'snapshots', count(distinct (icao24, floor(last_contact / 3600))), count(*) from matched_speed""",
    "stream_latest": _LATEST.format(keys="icao24", extra=""),
    "stream_latest_compacted": _LATEST.format(keys="icao24", extra=""),
    "stream_hourly_published": _HOURLY,
    "stream_hourly": _HOURLY,
    "stream_late": """
        select cast(floor(time / 3600) * 3600 as bigint) as hour_start, count(*) as reports,
               cast(sum(case when event_id % 2 = 1 and time < newest - 600 then 1 else 0 end) as bigint) as late
        from telemetry, (select max(time) as newest from telemetry where event_id % 2 = 0 and icao24 is not null)
        where icao24 is not null group by 1""",
    "stream_serving": f"""
        select airline_name, count(icao24) as total_flights, {_SERVING_MEANS}
        from unified where airline_name is not null group by 1""",
}


def _needed(sql: str, found: set[str]) -> None:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b(from|join)\s+{name}\b", sql):
            found.add(name)
            _needed(body, found)


def oracle(name: str) -> str:
    """The check of one query, with the blocks it needs in order of definition."""
    found: set[str] = set()
    _needed(CHECKS[name], found)
    blocks = [f"{n} as ({CTES[n]})" for n in CTES if n in found]
    return (f"with {', '.join(blocks)} " if blocks else "") + CHECKS[name]


def oracles() -> dict[str, str]:
    return {name: oracle(name) for name in CHECKS}
