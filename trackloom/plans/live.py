"""The live feed: enrichment, state and hourly snapshots, started together."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..functions import in_bbox
from ..streaming.enrich import enrich_flights, start_enrichment
from ..streaming.state import start_accumulation, start_hourly_snapshots
from ..sources.payloads import parse_json


def live_job(
    source: DataFrame,
    routes: DataFrame,
    checkpoint: str,
    sink: str,
    sink_options: dict[str, str] | None = None,
    state_path: str | None = None,
    snapshot_path: str | None = None,
    epoch: str = "last_contact",
    box: Mapping[str, float] | None = None,
    **trigger,
) -> dict:
    """Starts the enrichment and, where a path is given, state and hourly snapshots.

    ``box`` (such as ``reference_data.STREAM_REGION_BOX``) keeps state and snapshots to a
    region.

    Returns the running queries by name. Each has its own checkpoint and restarts alone.
    """
    queries = {
        "enrichment": start_enrichment(
            source, routes, sink, f"{checkpoint}/enrichment", key="icao24",
            sink_options=sink_options, **trigger,
        )
    }
    enriched = enrich_flights(parse_json(source), routes)
    if box is not None:
        enriched = enriched.filter(in_bbox("latitude", "longitude", box))
    if state_path:
        queries["state"] = start_accumulation(
            enriched, state_path, f"{checkpoint}/state", epoch=epoch, **trigger
        )
    if snapshot_path:
        queries["snapshots"] = start_hourly_snapshots(
            enriched, snapshot_path, f"{checkpoint}/snapshots", epoch=epoch, **trigger
        )
    return queries
