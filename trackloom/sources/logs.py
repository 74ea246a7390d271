"""Log files below ``dag_id=…/run_id=…/task_id=…`` folders, as rows of text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import with_line_order


def read_logs(
    spark: SparkSession, root: str, since: str | None = None, pattern: str = "*.log"
) -> DataFrame:
    """``dag, run, task, file, modified, block, line_id, line`` of every log below ``root``.

    ``since`` (``YYYY-MM-DDTHH:MM:SS``) leaves out files last changed before it; they
    are not opened.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if since:
        reader = reader.option("modifiedAfter", since)
    lines = with_line_order(reader.text(root))
    path = F.col("_file")

    def part(name):
        return F.nullif(F.regexp_extract(path, rf"{name}=([^/]+)", 1), F.lit(""))

    system = path.rlike("scheduler|wrapper|spark")
    return lines.select(
        F.coalesce(part("dag_id"), F.when(system, "system-logs").otherwise("other")).alias("dag"),
        part("run_id").alias("run"),
        part("task_id").alias("task"),
        path.alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_block").alias("block"),
        F.col("_line").alias("line_id"),
        F.col("value").alias("line"),
    )
