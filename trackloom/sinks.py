"""Writers for tables, extracts, ledgers and streams."""

import gzip
import io
import sys
import tarfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyarrow.fs import FileSystem
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions import utc_date, utc_hour
from .schemas import LEDGER

# functions for tasks are shipped by value, so executors do not need this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counted(df: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """Counts rows (and ``measures``) while the frame is written, without a job of its own."""
    seen = Observation()
    columns = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in measures.items()]
    return df.observe(seen, *columns), seen


def write_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "append",
    by: Sequence[str] = ("year", "month"),
    rows_per_file: int | None = 5_000_000,
    cluster: bool = False,
) -> None:
    """Parquet in partition folders.

    ``mode="overwrite_partitions"`` replaces only the partitions that the rows belong
    to, so a rerun of one month leaves the others. ``cluster`` asks for a shuffle by
    partition first, which avoids many small files; Spark splits and coalesces its
    output by size, so a partition with most of the rows is still written by many tasks.
    """
    if cluster:
        df = df.hint("rebalance", *by)
    writer = df.write.partitionBy(*by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if mode == "overwrite_partitions":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes folders of one store with all they hold; one that is not there is no error."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    store = new(paths[0]).getFileSystem(spark._jsc.hadoopConfiguration()) if paths else None
    for path in paths:
        store.delete(new(path), True)


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, in any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data))
    out.close()


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern such as ``…/batch=*``, sorted. Nothing is opened."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(f.getPath().toString() for f in found or [])


def with_hour_partitions(df: DataFrame, epoch: str | Column = "time") -> DataFrame:
    """Zero-padded ``year, month, day, hour`` folders from event time."""
    date = utc_date(epoch)
    return df.withColumns(
        {
            "year": F.date_format(date, "yyyy"),
            "month": F.date_format(date, "MM"),
            "day": F.date_format(date, "dd"),
            "hour": F.lpad(utc_hour(epoch).cast("string"), 2, "0"),
        }
    )


def write_hourly(df: DataFrame, path: str, epoch: str | Column = "time", mode: str = "append") -> None:
    write_partitioned(
        with_hour_partitions(df, epoch), path, mode, ("year", "month", "day", "hour")
    )


def replace_batch(df: DataFrame, path: str, batch: str, by: Sequence[str] = (), column: str = "batch") -> None:
    """Stores the rows of one load below ``<column>=<batch>``, in place of what it held.

    Any text can be the name of a load; signs that folders cannot hold are escaped the
    way Spark reads them.
    """
    name = "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{}[]^\x7f" or c < " " else c for c in batch)
    writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{column}={name}")


def _archive(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """One task's rows as a gzipped CSV in an archive that appears under its name when it is whole."""
    content, rows = io.BytesIO(), 0
    with gzip.GzipFile(fileobj=content, mode="wb", mtime=0) as packed:
        for batch in batches:
            if not rows:
                packed.write((",".join(batch.schema.names) + "\n").encode())
            rows += batch.num_rows
            pa_csv.write_csv(batch, packed, pa_csv.WriteOptions(include_header=False, quoting_style="needed"))
    if not rows:
        return
    store, folder = FileSystem.from_uri(path)
    store.create_dir(folder, recursive=True)
    task = TaskContext.get()
    name = f"part-{task.partitionId():05d}"
    hidden = f"{folder}/_{name}-{task.taskAttemptId()}"
    with store.open_output_stream(hidden) as out, tarfile.open(fileobj=out, mode="w|") as tar:
        member = tarfile.TarInfo(f"{name}.csv.gz")
        member.size = content.tell()
        content.seek(0)
        tar.addfile(member, content)
    store.move(hidden, f"{folder}/{name}.tar")
    yield pa.RecordBatch.from_pylist([{"archive": f"{name}.tar", "rows": rows}])


def write_tar_csv(df: DataFrame, path: str) -> int:
    """Tar archives of one gzipped CSV each, one per partition of ``df``; returns their number.

    They are packed by the tasks, in any store that pyarrow knows. A task that is repeated
    replaces its archive by the same one. A partition's compressed rows are held in memory.
    """
    made = df.mapInArrow(lambda batches: _archive(batches, path), "archive string, rows long")
    return made.agg(F.count(F.lit(1))).first()[0]


def export_csv(df: DataFrame, path: str, order: Sequence[Column | str], single_file: bool = False) -> None:
    """An ordered CSV extract with header, in parts whose names sort in row order.

    ``single_file`` passes everything through one task.
    """
    ordered = df.orderBy(*order)
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(path)


def ledger_rows(files: DataFrame, layer: str, counts: DataFrame | None = None) -> DataFrame:
    """Ledger rows for a file listing; ``counts`` holds ``file_path, record_count``."""
    rows = files.select(
        F.col("path").alias("file_path"),
        F.lit(layer).alias("layer"),
        F.current_timestamp().alias("processed_at"),
        F.col("length").alias("file_size_bytes"),
    )
    if counts is None:
        return rows.withColumn("record_count", F.lit(0).cast("bigint"))
    return rows.join(counts, "file_path", "left").withColumn(
        "record_count", F.coalesce("record_count", F.lit(0))
    )


def upsert_ledger(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or update by ``file_path``: the new row replaces the old one."""
    columns = ledger.columns
    both = ledger.withColumn("_new", F.lit(0)).unionByName(
        new.select(*columns).withColumn("_new", F.lit(1))
    )
    rest = [c for c in columns if c != "file_path"]
    return (
        both.groupBy("file_path")
        .agg(F.max(F.struct("_new", *rest)).alias("r"))
        .select(*[F.col(c) if c == "file_path" else F.col(f"r.{c}") for c in columns])
    )


def append_ledger(new: DataFrame, path: str, run: str, replace_all: bool = False) -> None:
    """Adds ledger rows under the id of a run; repeating the run replaces its own rows.

    ``replace_all`` drops the rows of all other runs, as a full load reads every file.
    """
    if replace_all:
        write_partitioned(new.withColumn("run", F.lit(run)), path, "overwrite", ("run",), None)
    else:
        replace_batch(new, path, run, column="run")


def read_ledger(spark: SparkSession, path: str, without: str | None = None) -> DataFrame | None:
    """Ledger rows of all runs but ``without``; None when there is no ledger."""
    from .sources.files import read_optional

    found = read_optional(spark, path, f"{LEDGER}, run string")
    if found is None:
        return None
    if without is not None:
        found = found.filter(F.col("run") != without)
    return found.drop("run")


def write_stream(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    available_now: bool = False,
    by: Sequence[str] = (),
    **options: str,
):
    """Starts a stream into any sink (kafka, parquet, console, …) and returns the query."""
    writer = df.writeStream.format(sink).outputMode(mode).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def write_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None
):
    """JSON rows (``value``, and ``key`` if present) into a Kafka topic."""
    return write_stream(
        df, "kafka", checkpoint, every=every,
        **{"kafka.bootstrap.servers": servers, "topic": topic},
    )


def show_stream(df: DataFrame, columns: Sequence[str], checkpoint: str, every: str = "10 seconds"):
    """A few columns of a stream on the console, for looking at it."""
    return write_stream(
        df.select(*columns), "console", checkpoint, every=every, truncate="false"
    )
