"""Keyed state of the live feed.

State is one row per object, so it is bounded by the number of objects, not by the
number of reports. Order is event time; the checkpoint carries the state over a restart.
``ROCKSDB`` keeps large state off the heap.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import event_time
from ..operators.filters import with_processing_metadata
from ..operators.live import accumulate
from ..sinks import counted, folders, remove, with_hour_partitions, write_partitioned
from ..sources.files import read_optional

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def use_rocksdb(spark: SparkSession) -> None:
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)


#: a manifest version: batches up to ``high`` are in the listed generations
_MANIFEST = "high long, generations array<struct<level: int, folder: string>>"
#: so many batches, or generations of a level, are merged into one of the next level
FAN = 4
BUCKETS = 16


def upsert_state(changes: DataFrame, path: str, batch_id: int) -> None:
    """Writes the objects that changed in one micro-batch; repeating the batch is harmless.

    A batch without changes leaves no folder.
    """
    rows, written = counted(changes)
    target = f"{path}/batches/batch={batch_id}"
    rows.write.mode("overwrite").parquet(target)
    if not written.get["rows"]:
        remove(changes.sparkSession, target)


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def _batches(spark: SparkSession, path: str, beyond: int) -> list[int]:
    """Ids of the stored batches behind ``beyond``."""
    found = (_number(f) for f in folders(spark, f"{path}/batches/batch=*"))
    return sorted(b for b in found if b > beyond)


def _manifest(spark: SparkSession, path: str) -> tuple[int, int, list]:
    """Number, highest merged batch and generations of the newest manifest version.

    A version becomes visible as a whole, when its only file is renamed into place.
    """
    found = read_optional(spark, f"{path}/manifest", f"{_MANIFEST}, version int")
    newest = found.orderBy(F.desc("version")).first() if found is not None else None
    return (newest.version, newest.high, list(newest.generations)) if newest else (0, -1, [])


def _layers(spark: SparkSession, path: str, batches: list[int], generations: list, buckets: list[int] | None = None) -> DataFrame:
    """The rows of some batches and generations, each with the ``batch`` it is from."""
    parts = []
    if generations:
        merged = spark.read.option("basePath", f"{path}/levels").parquet(*[f"{path}/levels/{g.folder}" for g in generations])
        merged = merged if buckets is None else merged.filter(F.col("bucket").isin(buckets))
        parts.append(merged.drop("generation", "bucket"))
    if batches:
        own = spark.read.option("basePath", f"{path}/batches").parquet(*[f"{path}/batches/batch={b}" for b in batches])
        parts.append(own.withColumn("batch", F.col("batch").cast("long")))
    if not parts:
        raise FileNotFoundError(f"no state at {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(rows: DataFrame, key: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max(F.struct("batch", *rest)).alias("r")).select(key, "r.*")


def read_state(spark: SparkSession, path: str, key: str = "icao24", only: Sequence | None = None) -> DataFrame:
    """The newest row per object of a table kept by ``start_accumulation``.

    Reads the generations of the manifest and the batches behind them. ``only`` names a few
    objects: of the generations their buckets alone are read then.
    """
    _, high, generations = _manifest(spark, path)
    batches = _batches(spark, path, high)
    rows = _layers(spark, path, batches, generations)
    if only is not None:
        named = spark.createDataFrame([(o,) for o in only], f"{key} {dict(rows.dtypes)[key]}")
        buckets = [r.bucket for r in named.select(_bucket(key)).distinct().collect()]
        rows = _layers(spark, path, batches, generations, buckets).filter(F.col(key).isin(list(only)))
    return _newest(rows, key).drop("batch")


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def merge_state(spark: SparkSession, path: str, key: str = "icao24", fan: int = FAN, settled: bool = False) -> bool:
    """Merges small batches into larger generations, beside a running stream.

    ``fan`` batches become a generation of level 1, ``fan`` generations of a level one of the next, so
    there are about ``fan`` times the logarithm of the batches of them, and a row is rewritten once
    per level. A generation is laid out in buckets of the key. The next manifest version switches
    readers over at once; folders that it replaces are dropped by the merge after next, so a reader
    that began before can end. The stream only adds batches and is never waited for; its newest
    batch may still be written or repeated and is left out unless the stream is known to be stopped
    (``settled``). One merge runs at a time: a second one fails on the version that the first wrote.
    Returns whether there was anything to merge.
    """
    version, high, generations = _manifest(spark, path)
    waiting = _batches(spark, path, high)
    if not settled:
        waiting = waiting[:-1]
    if len(waiting) < fan and not (settled and len(waiting) > 1):
        return False
    level, merged = 1, []
    while len(same := [g for g in generations if g.level == level]) >= fan - 1:
        merged += same
        level += 1
    kept = [g for g in generations if g not in merged]
    folder = f"generation={version + 1:08d}"
    rows = _newest(_layers(spark, path, waiting, merged), key)
    rows.withColumn("bucket", _bucket(key)).repartition(BUCKETS, "bucket").write.mode("overwrite").partitionBy(
        "bucket"
    ).parquet(f"{path}/levels/{folder}")
    entry = (waiting[-1], [(g.level, g.folder) for g in kept] + [(level, folder)])
    spark.createDataFrame([entry], _MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/version={version + 1}")
    _drop_replaced(spark, path, version, high, {g.folder for g in [*generations, *kept]} | {folder})
    return True


def _drop_replaced(spark: SparkSession, path: str, version: int, high: int, named: set[str]) -> None:
    """Drops what neither the manifest version ``version`` nor the one after it refers to."""
    for old in folders(spark, f"{path}/batches/batch=*"):
        if _number(old) <= high:
            remove(spark, old)
    for old in folders(spark, f"{path}/levels/generation=*"):
        if old.rsplit("/", 1)[1] not in named:
            remove(spark, old)
    for old in folders(spark, f"{path}/manifest/version=*"):
        if _number(old) < version:
            remove(spark, old)


def compact_state(spark: SparkSession, path: str, target: str, key: str = "icao24") -> None:
    """Rewrites a state table as one batch in another folder, while its stream is stopped.

    The stream may then go on with ``target`` as its path and its old checkpoint: its
    batch numbers continue, so newer rows still win.
    """
    _, high, _ = _manifest(spark, path)
    upsert_state(read_state(spark, path, key), target, max([high, *_batches(spark, path, high)]))


def start_accumulation(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "icao24",
    epoch: str = "time",
    ties: tuple[str, ...] = (),
    every: str | None = None,
    available_now: bool = False,
    merge_every: int | None = None,
):
    """Keeps the latest row, first and last time and count per object; update mode.

    Each micro-batch writes only what changed. ``merge_every`` so many batches the stream merges
    its small ones itself (``merge_state``); another program may do so instead.
    """

    def store(batch, batch_id):
        upsert_state(batch, path, batch_id)
        if merge_every and batch_id % merge_every == merge_every - 1:
            merge_state(batch.sparkSession, path, key)

    writer = (
        accumulate(stream, key, epoch, ties)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def hourly_snapshots(
    df: DataFrame,
    key: str = "icao24",
    epoch: str = "time",
    ties: tuple[str, ...] = (),
    width: str = "1 hour",
    late: Column | None = None,
) -> DataFrame:
    """Per object and hour of event time: its latest row, first and last time, count.

    For a table, or one micro-batch: ``start_hourly_snapshots`` keeps them for a stream. With a condition
    ``late`` also ``late_count``, the reports that meet it.
    """
    lateness = {} if late is None else {"late_count": F.count_if(late)}
    timed = df.withColumn("_time", event_time(epoch))
    rest = [c for c in df.columns if c not in (key, epoch, *ties)]
    return (
        timed.filter(F.col(key).isNotNull())
        .groupBy(F.window("_time", width).alias("_hour"), key)
        .agg(
            F.max(F.struct(epoch, *ties, *rest)).alias("_latest"),
            F.min(epoch).alias("first_seen"),
            F.max(epoch).alias("last_seen"),
            F.count(F.lit(1)).alias("position_count"),
            *[c.alias(n) for n, c in lateness.items()],
        )
        .select(
            F.unix_seconds("_hour.start").alias("hour_start"),
            key,
            *[f"_latest.{c}" for c in (epoch, *ties, *rest)],
            "first_seen",
            "last_seen",
            "position_count",
            *lateness,
        )
    )


# Below a table of hours there are two hidden ones:
#   _parts/batch=               snapshots of one micro-batch, until they are merged
#   _merged/hour_start=/upto=   an hour with all batches up to that one
#   _late/batch=                reports and late reports per hour, of all batches up to that one
# The highest ``upto`` of an hour says which batches it holds, so it is the hour's manifest: rows of a
# part count for an hour if their batch is behind it. An hour's folder appears as a whole when a
# write is committed.


def store_hours(
    reports: DataFrame,
    path: str,
    batch: int,
    key: str = "icao24",
    epoch: str = "time",
    ties: tuple[str, ...] = (),
    late_after: int | None = None,
) -> None:
    """Stores a batch's own hourly snapshots beside the hours; repeating it changes nothing.

    With ``late_after`` reports more than so many seconds behind the newest of earlier batches are
    counted as late, from the same pass over the batch.
    """
    spark, late, before = reports.sparkSession, None, None
    if late_after is not None:
        before = _lateness(spark, path, int(batch))
        mark = before.agg(F.max("newest")).first()[0] if before is not None else None
        late = F.lit(False) if mark is None else F.col(epoch) < mark - late_after
    own, written = counted(hourly_snapshots(reports, key, epoch, ties, late=late))
    target = f"{path}/_parts/batch={int(batch)}"
    own.sortWithinPartitions("hour_start").write.mode("overwrite").parquet(target)
    if not written.get["rows"]:
        remove(spark, target)
    elif late is not None:
        _add_lateness(spark, path, int(batch), spark.read.schema(own.schema).parquet(target), before)


_LATE = "hour_start long, reports long, late long, newest long"


def _lateness(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The counts of the last batch, or of the last one before ``below``."""
    held = read_optional(spark, f"{path}/_late", f"{_LATE}, batch long")
    if held is None:
        return None
    held = held if below is None else held.filter(F.col("batch") < below)
    last = held.agg(F.max("batch")).first()[0]
    return held.filter(F.col("batch") == F.lit(last)).drop("batch")


def _add_lateness(spark: SparkSession, path: str, batch: int, own: DataFrame, before: DataFrame | None) -> None:
    """Writes the counts up to ``batch`` and drops all older ones but the last, for a repeated batch."""
    rows = own.groupBy("hour_start").agg(
        F.sum("position_count").alias("reports"),
        F.sum("late_count").alias("late"),
        F.max("last_seen").cast("long").alias("newest"),
    )
    total = rows if before is None else rows.unionByName(before)
    total = total.groupBy("hour_start").agg(
        F.sum("reports").alias("reports"), F.sum("late").alias("late"), F.max("newest").alias("newest")
    )
    total.coalesce(1).write.mode("overwrite").parquet(f"{path}/_late/batch={batch}")
    older = sorted((_number(f), f) for f in folders(spark, f"{path}/_late/batch=*") if _number(f) < batch)
    remove(spark, *[f for _, f in older[:-1]])


def late_reports(spark: SparkSession, path: str) -> DataFrame:
    """(hour_start, reports, late) of the hours of a stream that was started with ``late_after``.

    A late report changes an hour that readers may have taken as complete; it is merged all the same.
    """
    held = _lateness(spark, path)
    held = spark.createDataFrame([], _LATE) if held is None else held
    return held.drop("newest")


def _parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all batches that wait, with their ``batch``."""
    if not folders(spark, f"{path}/_parts/batch=*"):
        return None
    return spark.read.parquet(f"{path}/_parts").withColumn("batch", F.col("batch").cast("long"))


def _merged(spark: SparkSession, path: str, upto: dict[int, int]) -> DataFrame | None:
    """Merged rows of some hours; folders of other hours are not listed."""
    paths = [f"{path}/_merged/hour_start={h}/upto={n}" for h, n in sorted(upto.items())]
    if not paths:
        return None
    rows = spark.read.option("basePath", f"{path}/_merged").parquet(*paths).drop("upto")
    return rows.withColumn("hour_start", F.col("hour_start").cast("long"))


def _versions(spark: SparkSession, path: str, hours: Iterable[int]) -> dict[int, list[int]]:
    """Up to which batches there are folders of some hours, -1 first; all from one call of the store."""
    found = {h: [-1] for h in hours}
    for folder in folders(spark, f"{path}/_merged/hour_start={{{','.join(map(str, found))}}}/upto=*"):
        hour, upto = folder.rsplit("/", 2)[1:]
        found[_number(hour)].append(_number(upto))
    return {h: sorted(own) for h, own in found.items()}


def hour_input(spark: SparkSession, path: str, hours: dict[int, int]) -> DataFrame:
    """What is to be merged into some hours, given up to which batch each is merged (or -1).

    Waiting rows behind that batch, and the merged rows of those hours.
    """
    held = spark.createDataFrame(sorted(hours.items()), "hour_start long, upto long")
    new = _parts(spark, path).join(held, "hour_start").filter(F.col("batch") > F.col("upto")).drop("batch", "upto", "late_count")
    before = _merged(spark, path, {h: n for h, n in hours.items() if n >= 0})
    return new if before is None else new.unionByName(before)


def publish_hours(
    spark: SparkSession,
    path: str,
    key: str = "icao24",
    epoch: str = "time",
    ties: tuple[str, ...] = (),
    files_per_hour: int = 8,
) -> list[int]:
    """Merges waiting parts into their hours and brings ``year=/month=/day=/hour=`` folders up to date.

    Reads the waiting parts and the hours that they touch, and returns those; a late report is thus
    merged into its hour. Merged parts are dropped. If a run is lost on the way the next one goes
    on from what is stored: parts that a merged hour holds do not count again.
    """
    parts, waiting = _parts(spark, path), folders(spark, f"{path}/_parts/batch=*")
    if parts is None:
        return []
    touched = {r.hour_start: r.last for r in parts.groupBy("hour_start").agg(F.max("batch").alias("last")).collect()}
    versions = _versions(spark, path, touched)
    behind = {h: versions[h][-1] for h, last in touched.items() if last > versions[h][-1]}
    upto = max(touched.values())
    if behind:
        stored = hour_input(spark, path, behind)
        added = ("hour_start", key, "first_seen", "last_seen", "position_count")
        order = [epoch, *ties, *[c for c in stored.columns if c not in (*added, epoch, *ties)]]
        rows = (
            stored.groupBy("hour_start", key)
            .agg(
                F.max(F.struct(*order)).alias("_latest"),
                F.min("first_seen").alias("first_seen"),
                F.max("last_seen").alias("last_seen"),
                F.sum("position_count").alias("position_count"),
            )
            .select("hour_start", key, *[f"_latest.{c}" for c in order], *added[2:], F.lit(upto).cast("long").alias("upto"))
        )
        write_partitioned(rows, f"{path}/_merged", "overwrite_partitions", ("hour_start", "upto"), cluster=True)
        for hour in behind:
            versions[hour].append(upto)
    current = _merged(spark, path, {h: own[-1] for h, own in versions.items()})
    spread = F.pmod(F.xxhash64(key), F.lit(files_per_hour))
    write_partitioned(
        with_hour_partitions(with_processing_metadata(current), "hour_start").repartition("hour_start", spread),
        path, "overwrite_partitions", ("year", "month", "day", "hour"),
    )
    replaced = [f"{path}/_merged/hour_start={h}/upto={n}" for h, own in versions.items() for n in own[1:-1]]
    remove(spark, *waiting, *replaced)
    return sorted(touched)


def start_hourly_snapshots(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
    files_per_hour: int = 8,
    key: str = "icao24",
    epoch: str = "time",
    ties: tuple[str, ...] = (),
    publish: bool = True,
    late_after: int | None = None,
):
    """Keeps ``year=/month=/day=/hour=`` folders up to date with every report.

    Reports may come in any order: a late one is merged into its hour, none is dropped,
    and the last hour needs no later report to come out. A batch reads and rewrites the hours it
    touches and no others. The few rows of an hour (one per object) are spread over
    ``files_per_hour`` tasks. A backlog, whose batches touch all hours, is quicker read with
    ``publish=False`` and one ``publish_hours`` at its end. ``late_after`` seconds behind the newest report of
    earlier batches a report counts as late (``late_reports``).
    """

    def store(batch, batch_id):
        store_hours(batch, path, batch_id, key, epoch, ties, late_after)
        if publish:
            publish_hours(batch.sparkSession, path, key, epoch, ties, files_per_hour)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
