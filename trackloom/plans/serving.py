"""Silver layers to the serving tables, in full or for new files only."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_unified
from ..operators.serving import SERVING_TABLES
from ..sinks import append_ledger, counted, ledger_rows, read_ledger
from ..sources.files import read_new_files, read_optional
from ..streaming.serve import batch_states, serving_table, store_batch


def serving_job(
    spark: SparkSession,
    batch_path: str,
    speed_path: str,
    root: str,
    run: str,
    full: bool = False,
    publish: Callable[[DataFrame, str], int] | None = None,
) -> dict[str, int]:
    """Loads the unified states and brings the four serving tables up to date.

    ``run`` names the load. States, partial aggregates and ledger rows are stored under
    it, and the ledger comes last: a load that is repeated under the same name, whether
    it broke off or not, takes its own files again and counts nothing twice. An
    incremental load reads only files that no other load has in the ledger, and
    aggregates only those. The ledger has one row per file.
    """
    ledger_path = f"{root}/ledger"
    ledger = None if full else read_ledger(spark, ledger_path, without=run)
    layers: dict[str, DataFrame | None] = {}
    listings: dict[str, DataFrame] = {}
    for layer, path in (("batch", batch_path), ("speed", speed_path)):
        if read_optional(spark, path) is None:
            layers[layer] = None
            continue
        known = None if ledger is None else ledger.filter(F.col("layer") == layer)
        layers[layer], listings[layer] = read_new_files(spark, path, known)
    merged = merge_unified(layers["batch"], layers["speed"])
    if merged is None:
        return {"states": 0, "files": 0}
    store_batch(merged, root, run, replace_all=full)
    states = batch_states(spark, root, run, merged.schema).count()
    new_rows = None
    for layer, listing in listings.items():
        if layers[layer] is not None:
            counts = (
                layers[layer]
                .groupBy(F.col("_source_file").alias("file_path"))
                .agg(F.count(F.lit(1)).alias("record_count"))
            )
            rows = ledger_rows(listing, layer, counts)
            new_rows = rows if new_rows is None else new_rows.unionByName(rows)
    new_rows, seen = counted(new_rows)
    append_ledger(new_rows, ledger_path, run, full)
    files = seen.get["rows"]
    if publish is not None:
        for table in SERVING_TABLES:
            current = serving_table(spark, root, table)
            if current is not None:
                publish(current, table.name)
    return {"states": states, "files": files}

