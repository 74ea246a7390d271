"""Reports on runs, logs and storage."""

from pyspark.sql import DataFrame, SparkSession

from ..operators.ops import log_summary, storage_metrics, task_metrics
from ..sources.logs import read_logs


def ops_job(
    spark: SparkSession, log_root: str, layers: dict[str, str], since: str | None = None, pattern: str = "*.log"
) -> dict[str, DataFrame]:
    """Task metrics, important log lines and storage figures, as DataFrames."""
    logs = read_logs(spark, log_root, since, pattern)
    return {
        "tasks": task_metrics(logs),
        "log_lines": log_summary(logs),
        "storage": storage_metrics(spark, layers),
    }
