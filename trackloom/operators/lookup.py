"""Routes and attributes looked up in dimension tables.

No operator here hints a broadcast. Fixed tables are local relations whose size Catalyst knows; stored
tables are planned by their file size; anything else is re-planned by AQE from the
size it really has, and is a sort-merge join with skew splitting beyond that.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions import (
    airline_iata,
    all_digits,
    clean_code,
    flight_number,
    known_prefix,
    make_callsign,
    trailing_digits,
)
from .filters import has_text, with_both_ends, without_self_loops

# no call sign holds a line feed, so a key that begins with one matches nothing
NULL_SPREAD = 1024


def spread_nulls(df: DataFrame, key: Column) -> Column:
    """``key`` with nulls replaced by one of many keys that match nothing, by the row's values."""
    salt = F.pmod(F.xxhash64(*df.columns[:4]), F.lit(NULL_SPREAD)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\n"), salt))


ROUTE_COLUMNS = (
    "departure_airport", "arrival_airport", "route", "aircraft_model", "aircraft_type",
)


def enrich_routes(
    states: DataFrame,
    mapping: DataFrame,
    callsign: str = "callsign",
) -> DataFrame:
    """Adds route and aircraft columns of the cleaned call sign; keeps every state.

    ``mapping`` has one row per call sign. Whether it is broadcast is left to the
    planner, which knows its bytes; where it is not, missing call signs, which match
    nothing, are spread over all tasks instead of meeting in one.
    """
    side = mapping.select(F.col("callsign").alias("_callsign"), *ROUTE_COLUMNS)
    key = spread_nulls(states, clean_code(states[callsign]))
    return states.join(side, key == side["_callsign"], "left").drop("_callsign")


def with_airport_attributes(
    df: DataFrame,
    airports: DataFrame,
    ends: Sequence[str] = ("origin", "destination"),
) -> DataFrame:
    """City, airport name and coordinates for ``<end>_code``, as ``<end>_city`` and so on."""
    for end in ends:
        side = airports.select(
            F.col("code").alias(f"{end}_code"),
            F.col("city").alias(f"{end}_city"),
            F.col("name").alias(f"{end}_airport"),
            F.col("lat").alias(f"{end}_lat"),
            F.col("lon").alias(f"{end}_lon"),
        )
        df = df.join(side, f"{end}_code", "left")
    return df


def with_airline_attributes(df: DataFrame, airlines: DataFrame, prefix: str = "airline_prefix") -> DataFrame:
    """Carrier name and codes of a call-sign prefix."""
    side = airlines.select(
        F.col("airline_icao").alias(prefix),
        "airline_name",
        "airline_iata",
        F.col("airline_icao"),
    )
    return df.join(side, prefix, "left")


def schedule_carrier(df: DataFrame, carriers: DataFrame, flight: str = "flight_no") -> DataFrame:
    """IATA code, name and ICAO prefix of a flight number; ``XX/Unknown/UNK`` if not known."""
    code, name, prefix = ref.UNKNOWN_CARRIER
    keyed = df.withColumn("airline_iata", airline_iata(flight))
    known = carriers.withColumn("_known", F.lit(True))
    return (
        keyed.join(known, "airline_iata", "left")
        .withColumns(
            {
                "airline_iata": F.when(F.col("_known"), F.col("airline_iata")).otherwise(code),
                "airline_name": F.coalesce("airline_name", F.lit(name)),
                "airline_prefix": F.coalesce("airline_prefix", F.lit(prefix)),
            }
        )
        .drop("_known")
    )


def route_schedule(
    schedule: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    known_only: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """A published schedule (``FlightNo, Origin, Destination``) as routes by call sign.

    Self loops and incomplete rows are dropped. Of several rows for one call sign the
    smallest (flight number, origin, destination) stays, so the result does not
    depend on file order; with ``order`` the last row in that order stays instead.
    ``known_only`` also drops carriers that are not listed and flight numbers without
    digits at the end.
    """
    rows = without_self_loops(
        schedule.select(
            *order,
            F.col("FlightNo").alias("flight_no"),
            F.col("Origin").alias("origin_code"),
            F.col("Destination").alias("destination_code"),
        ).filter(F.col("flight_no").isNotNull())
    )
    number = trailing_digits("flight_no")
    if known_only:
        rows = rows.filter(has_text(number) & has_text("origin_code") & has_text("destination_code"))
    coded = schedule_carrier(rows, carriers).withColumn(
        "callsign", make_callsign("airline_prefix", number)
    )
    if known_only:
        coded = coded.filter(F.col("airline_prefix") != ref.UNKNOWN_CARRIER[2])
    row = F.struct(*order, "flight_no", "origin_code", "destination_code")
    one = coded.groupBy("callsign", "airline_iata", "airline_name", "airline_prefix").agg(
        (F.max(row) if order else F.min(row)).alias("r")
    )
    # a call sign belongs to one carrier, so this is one row per call sign
    return with_airport_attributes(
        one.select(
            "callsign",
            "r.flight_no",
            "airline_iata",
            "airline_name",
            "airline_prefix",
            F.col("airline_prefix").alias("airline_icao"),
            "r.origin_code",
            "r.destination_code",
        ),
        airports,
    )


def with_callsign_parts(
    df: DataFrame,
    callsign: str = "callsign",
    prefix: Column | None = None,
) -> DataFrame:
    """Trimmed call sign, its carrier prefix and flight number."""
    text = F.trim(callsign)
    return df.withColumns(
        {
            callsign: text,
            "airline_prefix": known_prefix(text, ref.LIVE_PREFIXES) if prefix is None else prefix,
            "flight_number": flight_number(text),
        }
    )


def enrich_callsign(
    df: DataFrame, airlines: DataFrame, rules: DataFrame, callsign: str = "callsign"
) -> DataFrame:
    """Carrier, route and number from the call sign alone; keeps every row.

    The number is made of all digits. ``airlines`` gives the known prefixes; a prefix
    without rules still names the carrier.
    """
    code = clean_code(callsign)
    parts = df.withColumns(
        {"airline_prefix": F.substring(code, 1, 3), "flight_number": all_digits(callsign)}
    )
    routed = enrich_by_rules(parts, rules).drop("rule_rank")
    named = with_airline_attributes(routed, airlines)
    known = F.when(F.col("airline_icao").isNotNull(), F.col("airline_prefix"))
    return named.withColumn("airline_prefix", known)


def enrich_exact(df: DataFrame, routes: DataFrame, callsign: str = "callsign") -> DataFrame:
    """Adds the columns of a route table with one row per call sign; keeps every row."""
    taken = set(df.columns) - {callsign}
    side = routes.select(
        F.col("callsign").alias("_callsign"),
        *[c for c in routes.columns if c != "callsign" and c not in taken],
    )
    key = spread_nulls(df, df[callsign])
    return df.join(side, key == side["_callsign"], "left").drop("_callsign")


def _rule(rules: DataFrame, prefix: str) -> Column:
    """A rule as one value; the smaller one has precedence."""
    rank = [c for c in ("rule_rank",) if c in rules.columns]
    return F.struct(*rank, *[c for c in rules.columns if c not in (prefix, *rank)])


def rules_by_prefix(rules: DataFrame, prefix: str = "airline_prefix") -> DataFrame:
    """One row per prefix: its rules as an array in order of precedence."""
    return rules.groupBy(prefix).agg(F.array_sort(F.collect_list(_rule(rules, prefix))).alias("_rules"))


def disjoint_rules(rules: DataFrame, prefix: str = "airline_prefix") -> DataFrame:
    """(prefix, start, rule): ranges that do not overlap, each up to the next start, with their first rule.

    A range is cut into aligned blocks of 2^level numbers, at most two a level, and each block keeps
    its first rule. The winner changes only where a range starts or ends, and there it is the
    first rule of the blocks around that number, one a level. So the work is rules times levels,
    however many overlap, and one prefix may hold all of them. ``rule`` is null in gaps.
    """
    shifted = lambda x, level: F.call_function("shiftright", x, level)
    lo, end, level = F.col("_lo"), F.col("_end"), F.col("_level")
    ranges = rules.select(
        prefix,
        F.col("min_flight_num").cast("long").alias("_lo"),
        (F.col("max_flight_num").cast("long") + 1).alias("_end"),
        _rule(rules, prefix).alias("_rule"),
    ).filter(F.col(prefix).isNotNull() & (lo < end))
    highest = F.ceil(F.log2(end - lo)).cast("int")
    first, behind = -shifted(-lo, level), shifted(end, level)
    edges = F.array(F.when(first % 2 != 0, first), F.when(behind % 2 != 0, behind - 1))
    blocks = (
        ranges.withColumn("_level", F.explode(F.sequence(F.lit(0), highest)))
        .filter(first < behind)
        .select(prefix, "_level", "_rule", F.explode(F.array_compact(edges)).alias("_block"))
        .groupBy(prefix, "_level", "_block")
        .agg(F.min("_rule").alias("_rule"))
    )
    starts = ranges.select(prefix, F.explode(F.array(lo, end)).alias("start")).distinct()
    around = starts.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(62))))
    around = around.withColumn("_block", shifted(F.col("start"), level))
    return (
        around.join(blocks, [prefix, "_level", "_block"], "left")
        .groupBy(prefix, "start")
        .agg(F.min("_rule").alias("rule"))
    )


def rule_index(rules: DataFrame, prefix: str = "airline_prefix") -> DataFrame:
    """One row per prefix: starts and winners of its disjoint ranges, for ``enrich_by_rules``."""
    ranges = F.array_sort(F.collect_list(F.struct("start", "rule")))
    side = disjoint_rules(rules, prefix).groupBy(prefix).agg(ranges.alias("_ranges"))
    return side.select(prefix, F.col("_ranges.start").alias("_starts"), F.col("_ranges.rule").alias("_rules"))


def count_up_to(sorted_values: Column, x: Column) -> Column:
    """How many values of a sorted array are at most ``x``, by halving steps; null for a null ``x``."""
    highest = F.length(F.bin(F.greatest(F.size(sorted_values), F.lit(0)))) - 1

    def step(at: Column, k: Column) -> Column:
        end = at + F.call_function("shiftleft", F.lit(1), k)
        return F.when((end <= F.size(sorted_values)) & (F.get(sorted_values, end - 1) <= x), end).otherwise(at)

    steps = F.sequence(highest, F.lit(0), F.lit(-1))
    return F.aggregate(F.when(x.isNotNull() & sorted_values.isNotNull(), steps), F.lit(0), step)


def enrich_by_rules(
    df: DataFrame,
    rules: DataFrame,
    policy: str = "first",
    prefix: str = "airline_prefix",
    number: str = "flight_number",
    keep_unmatched: bool = True,
) -> DataFrame:
    """Routes from number-range rules: prefix equal, flight number inside the range.

    What a prefix needs sits in one array, so this is an equi join without fan-out and no row
    is shuffled by a range. ``policy="first"`` takes the first rule in rank order, found by
    binary search in disjoint ranges; ``"all"`` gives one output row per matching rule, and every
    rule of the prefix is tested. Without a ``rule_rank`` rules rank by their values.
    With ``"first"``, ``rules`` can also be a stored ``rule_index``, which is then not built again.
    """
    if policy not in ("first", "all"):
        raise ValueError(f"unknown policy {policy!r}")
    n = F.col(number)
    if policy == "first":
        side = rules if "_starts" in rules.columns else rule_index(rules, prefix)
        hit = F.get("_rules", count_up_to(F.col("_starts"), n) - 1)
        if not keep_unmatched:  # as a generated row the rule is not looked up again by the filter on its ends
            hit = F.explode(F.array(hit))
    else:
        side = rules_by_prefix(rules, prefix)
        hit = F.explode_outer(F.filter("_rules", lambda r: n.between(r["min_flight_num"], r["max_flight_num"])))
    fields = side.schema["_rules"].dataType.elementType.names
    attributes = [c for c in fields if c not in ("min_flight_num", "max_flight_num") and c not in df.columns]
    joined = df.join(side, prefix, "left")
    out = joined.select(*df.columns, hit.alias("_rule")).select(
        *df.columns, *[F.col(f"_rule.{a}").alias(a) for a in attributes]
    )
    return out if keep_unmatched else with_both_ends(out)


def lookup_exact(
    df: DataFrame,
    primary: DataFrame,
    fallback: DataFrame,
    callsign: str = "callsign",
) -> DataFrame:
    """Origin and destination from ``primary``, else from ``fallback``, always as a pair."""
    key = spread_nulls(df, clean_code(df[callsign]))

    def side(routes, name):
        return routes.select(
            F.col("callsign").alias(f"_{name}_key"),
            F.struct("origin_code", "destination_code").alias(f"_{name}"),
        )

    first, second = side(primary, "first"), side(fallback, "second")
    pair = F.coalesce("_first", "_second")
    return (
        df.join(first, key == first["_first_key"], "left")
        .join(second, key == second["_second_key"], "left")
        .select(
            *[df[c] for c in df.columns],
            pair["origin_code"].alias("origin_code"),
            pair["destination_code"].alias("destination_code"),
        )
    )


def exact_route_table(rows: DataFrame, order: Sequence[Column | str] = ()) -> DataFrame:
    """``callsign, origin, destination`` rows as a route table with one row per call sign.

    The last row in ``order`` wins; equal places are settled by the values.
    """
    cleaned = rows.select(
        clean_code("callsign").alias("callsign"),
        F.struct(
            *order,
            clean_code("origin").alias("origin_code"),
            clean_code("destination").alias("destination_code"),
        ).alias("r"),
    )
    return cleaned.groupBy("callsign").agg(F.max("r").alias("r")).select(
        "callsign", "r.origin_code", "r.destination_code"
    )
