"""Route enrichment of the live feed. Stateless; the same functions work on tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import fill_unknown, with_both_ends
from ..operators.lookup import enrich_by_rules, enrich_exact, rule_index, with_callsign_parts
from ..sinks import write_stream
from ..sources.payloads import parse_json, to_json_value
from ..workspace import scratch_path

CARRIER_AND_ROUTE = [
    "airline_name", "airline_iata", "airline_icao",
    *[f"{end}_{part}" for end in ("origin", "destination")
      for part in ("code", "city", "airport", "lat", "lon")],
]


def _once(side: DataFrame) -> DataFrame:
    """``side`` written and read again, so that micro-batches do not compute it anew."""
    path = scratch_path(side.sparkSession, "rules")
    side.coalesce(1).write.parquet(path)
    return side.sparkSession.read.schema(side.schema).parquet(path)


def enrich_flights(
    flights: DataFrame,
    routes: DataFrame,
    policy: str = "first",
    prefix: Column | None = None,
    keep_unmatched: bool = False,
    fill: bool = False,
) -> DataFrame:
    """Carrier and route of every report.

    ``routes`` decides how: with a ``callsign`` column by exact call sign, otherwise by
    number ranges. Reports without a route are dropped unless ``keep_unmatched``;
    ``fill`` then puts in the texts for unknown carriers and routes.
    """
    parts = with_callsign_parts(flights, prefix=prefix)
    if "callsign" in routes.columns:
        side = routes.select("callsign", *CARRIER_AND_ROUTE)
        enriched = enrich_exact(parts, side)
    else:
        rank = [] if "rule_rank" not in routes.columns else ["rule_rank"]
        side = routes.select(
            *rank, "airline_prefix", "min_flight_num", "max_flight_num", *CARRIER_AND_ROUTE
        )
        if flights.isStreaming and policy == "first":
            side = _once(rule_index(side))
        enriched = enrich_by_rules(parts, side, policy, keep_unmatched=keep_unmatched).drop("rule_rank")
    if not keep_unmatched:
        return with_both_ends(enriched)
    return fill_unknown(enriched) if fill else enriched


def enrich_stream(
    source: DataFrame,
    routes: DataFrame,
    key: str | None = None,
    **options,
) -> DataFrame:
    """JSON ``value`` in, enriched JSON ``value`` out, with ``key`` as message key if given."""
    flights = parse_json(source)
    # text that is not JSON parses to a row without any identity
    known = flights.filter(F.col("icao24").isNotNull() | F.col("callsign").isNotNull())
    return to_json_value(enrich_flights(known, routes, **options), key)


def start_enrichment(
    source: DataFrame,
    routes: DataFrame,
    sink: str,
    checkpoint: str,
    every: str | None = None,
    available_now: bool = False,
    key: str | None = None,
    sink_options: dict[str, str] | None = None,
    **options,
):
    """Starts the enrichment job; sources and sinks are any that Spark knows."""
    return write_stream(
        enrich_stream(source, routes, key, **options),
        sink,
        checkpoint,
        every=every,
        available_now=available_now,
        **(sink_options or {}),
    )
