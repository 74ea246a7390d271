"""Raw files to the merged table: mapping, bronze, silver, gold."""

import hashlib
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean_code
from ..functions.time import DAY
from ..operators.filters import filter_region, region_routes
from ..operators.lookup import enrich_routes
from ..operators.merge import latest_per_key, merge_gold, sample_fraction, speed_as_states
from ..operators.star import build_mapping
from ..sinks import counted, export_csv, folders, remove, replace_batch, write_partitioned
from ..sources.files import (
    list_files,
    read_csv_tree,
    read_layer,
    read_optional,
    read_states,
    read_tar_lines,
    tar_states,
)
from ..workspace import scratch_path


class MissingMapping(RuntimeError):
    """The route mapping is absent or empty."""


def mapping_job(
    spark: SparkSession,
    history_root: str,
    mapping_path: str,
    region_csv: str | None = None,
    schema: str | None = schemas.HISTORY,
    epoch: str | None = "firstseen",
) -> dict[str, int]:
    """Flight history files to the route mapping, and the region's routes as a CSV extract.

    A call sign keeps its earliest flight by ``epoch``; files without that column give
    nulls there, which come last, and ties are settled by values.
    """
    history, read = counted(read_csv_tree(spark, history_root, schema))
    build_mapping(history, epoch).write.mode("overwrite").parquet(mapping_path)
    mapping = spark.read.parquet(mapping_path)
    figures = mapping.agg(
        F.count(F.lit(1)).alias("unique_callsigns"),
        F.coalesce(F.sum("flight_count"), F.lit(0)).alias("valid_records"),
    ).first()
    region = region_routes(mapping)
    in_region = region.count()
    if region_csv:
        export_csv(region, region_csv, [F.desc("flight_count"), F.col("callsign")])
    return {
        "total_records": read.get["rows"],
        **figures.asDict(),
        "region_routes": in_region,
    }


#: what a bronze load read: a row per file, with the figures of its load
_LOADED = "path string, length long, modification_time timestamp, records long, broken long, load string"


def bronze_job(
    spark: SparkSession,
    root: str,
    bronze_path: str,
    archives: bool = True,
    batch: str | None = None,
    modified_after: str | None = None,
    modified_before: str | None = None,
) -> dict[str, int]:
    """Adds position reports of the region to a parquet table by batch, year and month, in one pass.

    ``archives`` reads tar files; otherwise ``root`` holds CSV files. ``modified_after`` and
    ``modified_before`` (timestamps) bound the files. The files of every load are kept in a ledger
    beside the table, written last. Without a name the load takes the files that no load has
    taken yet and is stored under a name made from them, so that nothing is replaced or loaded
    twice and a load that was lost halfway is done again; where no file is new the figures are
    those of the loads that hold them. With a name the load takes all files and replaces the rows
    it had under that name, and nothing else. A file that is written anew is a new file. Damaged
    archives give no rows; they are counted, and ``sources.files.tar_errors`` names them.
    """
    bounds = {k: v for k, v in (("modifiedAfter", modified_after), ("modifiedBefore", modified_before)) if v}
    ledger_path = f"{bronze_path}/_files"
    listed = stored_files(spark, list_files(spark, root, "*.tar" if archives else "*.{csv,csv.gz}", **bounds))
    if batch is None:
        known = read_optional(spark, ledger_path, _LOADED)
        if known is not None:
            same = ["path", "modification_time"]
            held = known.join(listed.select(*same), same, "left_semi").select("load", "records", "broken").distinct()
            listed = listed.join(known.select(*same), same, "left_anti")
        files = sorted((r.path, str(r.modification_time)) for r in listed.select("path", "modification_time").toLocalIterator())
        if not files and known is not None:
            figures = held.agg(F.sum("records").alias("records"), F.sum("broken").alias("broken_archives")).first()
            return {k: v or 0 for k, v in figures.asDict().items()}
        batch = "files-" + hashlib.md5(repr(files).encode()).hexdigest()
        paths = [path for path, _ in files]
    else:
        paths = [r.path for r in listed.select("path").toLocalIterator()]
    if not paths:
        return {"records": 0, "broken_archives": 0}
    broken = None
    if archives:
        lines, broken = counted(read_tar_lines(spark, paths), broken=F.count("error"))
        states = tar_states(lines)
    else:
        states = read_states(spark, paths)
    kept, written = counted(filter_region(states))
    replace_batch(kept, bronze_path, batch, ("year", "month"))
    figures = {"records": written.get["rows"], "broken_archives": broken.get["broken"] if broken else 0}
    load = listed.withColumns(
        {"records": F.lit(figures["records"]).cast("long"), "broken": F.lit(figures["broken_archives"]).cast("long")}
    )
    replace_batch(load, ledger_path, batch, column="load")
    return figures


def stored_files(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """A listing as it is now: files that come while a load runs belong to the next one."""
    path = scratch_path(spark, "listing")
    listed.write.parquet(path)
    return spark.read.schema(listed.schema).parquet(path)


def require_mapping(spark: SparkSession, mapping_path: str) -> DataFrame:
    mapping = read_optional(spark, mapping_path)
    if mapping is None or mapping.isEmpty():
        raise MissingMapping(f"no route mapping at {mapping_path}")
    return mapping


def silver_job(
    spark: SparkSession,
    bronze_path: str,
    mapping_path: str,
    silver_path: str,
    since: tuple[int, int] | None = None,
    until: tuple[int, int] | None = None,
) -> dict[str, float]:
    """Bronze with routes. The match rate is counted while the rows are written.

    With ``since``/``until`` only those months are read and replaced.
    """
    mapping = require_mapping(spark, mapping_path)
    bronze = read_layer(spark, bronze_path, since, until).drop("batch")
    enriched, written = counted(enrich_routes(bronze, mapping), matched=F.count("route"))
    bounded = since is not None or until is not None
    write_partitioned(
        enriched, silver_path, "overwrite_partitions" if bounded else "overwrite", cluster=True
    )
    rows, matched = written.get["rows"], written.get["matched"]
    return {
        "records": rows,
        "matched": matched,
        "match_rate": round(matched * 100 / rows, 1) if rows else 0.0,
    }


def gold_job(
    spark: SparkSession,
    silver_path: str,
    speed_path: str,
    gold_path: str,
    full: bool = True,
    distinct: bool = False,
    since: str | None = None,
    days: int | None = None,
) -> dict[str, int]:
    """Batch and live states as one table.

    A full load rewrites it. An incremental load rewrites the months that the live layer
    holds and can be repeated; ``since`` (a timestamp) narrows them to months with live
    files modified after it. ``days`` keeps the reports of the last days before the newest one of
    both layers, whatever the load: months before the cut are dropped from the table, and an
    incremental load trims the month that the cut is in.

    ``distinct`` keeps the latest row per aircraft, clean call sign and last contact over
    both layers. Its table is partitioned by year and month only, as a month's rows of
    both layers are then rewritten together; otherwise also by layer, and an incremental
    load leaves the batch rows alone.
    """
    speed = read_optional(spark, speed_path)
    batch = read_optional(spark, silver_path) if full or distinct else None
    if not full and speed is None:
        return {"gold_records": 0}
    gold = merge_gold(batch, speed)
    if gold is None:
        return {"gold_records": 0}
    cut = None
    if days is not None:
        newest = [read_optional(spark, path) for path in (silver_path, speed_path)]
        ends = [d.agg(F.max(c)).first()[0] for d, c in zip(newest, ("time", "time_position")) if d is not None]
        cut = max((e for e in ends if e is not None), default=0) - days * DAY
    if not full:
        new = spark.read.schema(speed.schema).option("basePath", speed_path)
        new = (new.option("modifiedAfter", since) if since else new).parquet(speed_path)
        months = speed_as_states(new).select("year", "month").distinct().collect()
        if not months:
            return {"gold_records": 0}
        # one term per month, so that whole folders are skipped
        gold = gold.filter(reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in months]))
    if cut is not None:
        gold = gold.filter(F.col("time") >= cut)
    if distinct:
        code = gold.withColumn("_code", clean_code("callsign"))
        gold = latest_per_key(code, ["icao24", "_code", "lastcontact", "year", "month"], ["time"]).drop("_code")
    gold, written = counted(gold)
    by = ("year", "month") if distinct else ("data_source", "year", "month")
    write_partitioned(gold, gold_path, "overwrite" if full else "overwrite_partitions", by, cluster=True)
    if cut is not None and not full:
        _trim(spark, gold_path, cut, by)
    return {"gold_records": written.get["rows"]}


def _trim(spark: SparkSession, gold_path: str, cut: int, by: Sequence[str]) -> None:
    """Drops the reports before ``cut``: whole months as folders, the month of the cut by a rewrite."""
    first = datetime.fromtimestamp(cut, timezone.utc)
    edge = (first.year, first.month)
    for folder in folders(spark, "/".join([gold_path, *[f"{c}=*" for c in by]])):
        names = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
        if (int(names["year"]), int(names["month"])) < edge:
            remove(spark, folder)
    kept = spark.read.parquet(gold_path).filter((F.col("year") == edge[0]) & (F.col("month") == edge[1]))
    if kept.filter(F.col("time") < cut).isEmpty():
        return
    # read once more from a copy, as its own files are replaced
    copy = scratch_path(spark, "gold-edge")
    kept.filter(F.col("time") >= cut).write.partitionBy(*by).parquet(copy)
    before = folders(spark, "/".join([gold_path, *[f"{c}=*" for c in by[:-2]], f"year={edge[0]}", f"month={edge[1]}"]))
    write_partitioned(spark.read.schema(kept.schema).parquet(copy), gold_path, "overwrite_partitions", by, cluster=True)
    after = {f[f.index(copy) + len(copy):] for f in folders(spark, "/".join([copy, *[f"{c}=*" for c in by]]))}
    remove(spark, *[f for f in before if not any(f.endswith(a) for a in after)])


def sample_job(
    spark: SparkSession,
    path: str,
    sample_path: str,
    fraction: float,
    keys: Sequence[str] = ("icao24", "time"),
    seed: int = 42,
) -> dict[str, int]:
    """A fraction of a stored layer, chosen by a hash of its keys."""
    kept, written = counted(sample_fraction(spark.read.parquet(path), fraction, keys, seed))
    write_partitioned(kept, sample_path, "overwrite", cluster=True)
    return {"records": written.get["rows"]}
