"""Figures about runs, logs and stored files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..reference_data import LOG_KEYWORDS
from ..sources.files import list_files
from .merge import top_per_group

_STAMP = "yyyyMMdd'T'HHmmss"


def task_runs(logs: DataFrame) -> DataFrame:
    """One row per finished task attempt, from lines that mark a task's end."""
    line = F.col("line")
    marked = logs.filter(line.contains("Marking task as "))

    def field(name):
        return F.regexp_extract(line, rf"{name}=([^,\s]+)", 1)

    def stamp(name):
        return F.try_to_timestamp(field(name), F.lit(_STAMP))

    return marked.select(
        F.coalesce(F.nullif(field("dag_id"), F.lit("")), "dag").alias("dag"),
        "run",
        F.coalesce(F.nullif(field("task_id"), F.lit("")), "task").alias("task"),
        F.lower(F.regexp_extract(line, r"Marking task as (\w+)", 1)).alias("state"),
        stamp("start_date").alias("started"),
        stamp("end_date").alias("ended"),
    ).withColumn("seconds", F.unix_seconds("ended") - F.unix_seconds("started"))


def task_metrics(logs: DataFrame) -> DataFrame:
    """Per run: task count, successes, failures, total and mean seconds, efficiency.

    Efficiency is the sum of task times over the time from first start to last end, in
    percent. Tasks without both stamps count as tasks, not as time.
    """
    runs = task_runs(logs)
    ok = F.col("state") == "success"
    wall = F.unix_seconds(F.max("ended")) - F.unix_seconds(F.min("started"))
    total = F.sum("seconds")
    tasks = F.count(F.lit(1))
    return runs.groupBy("dag", "run").agg(
        tasks.alias("tasks"),
        F.count(F.when(ok, 1)).alias("successful_tasks"),
        F.count(F.when(~ok, 1)).alias("failed_tasks"),
        F.coalesce(total, F.lit(0)).alias("total_task_seconds"),
        wall.alias("wall_seconds"),
        F.try_divide(total, tasks).alias("mean_task_seconds"),
        F.try_divide(total * 100, wall).alias("efficiency_pct"),
    )


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence, k: int | None, rank: str) -> DataFrame:
    if k is not None:
        return top_per_group(df, keys, order, k, rank)
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def log_summary(
    logs: DataFrame,
    lines_per_file: int | None = None,
    files_per_group: int | None = None,
    keywords: Sequence[str] = LOG_KEYWORDS,
) -> DataFrame:
    """The important lines of every file, the last first; files ranked by age in their group.

    ``lines_per_file`` and ``files_per_group`` cut the report where they are given.
    """
    wanted = logs.filter(F.upper("line").rlike("|".join(keywords)))
    counts = wanted.groupBy("dag", "file", "modified").agg(
        F.count(F.lit(1)).alias("important_lines")
    )
    latest = ranked(counts, ["dag"], [F.desc("modified"), "file"], files_per_group, "file_rank")
    last = ranked(wanted, ["file"], [F.desc("block"), F.desc("line_id")], lines_per_file, "from_end")
    return last.select("file", "from_end", "line").join(latest, "file")


def storage_metrics(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Files and bytes of every layer (name to folder), from the listing alone."""
    parts = [
        list_files(spark, root).select(F.lit(name).alias("layer"), "path", "length")
        for name, root in layers.items()
    ]
    files = parts[0]
    for part in parts[1:]:
        files = files.unionByName(part)
    return files.groupBy("layer").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def folder_metrics(spark: SparkSession, root: str, k: int | None = None) -> DataFrame:
    """The folders below ``root`` with their file counts; the first ``k`` in path order if given."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    found = list_files(spark, root).groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"))
    return found if k is None else found.orderBy("folder").limit(k)
