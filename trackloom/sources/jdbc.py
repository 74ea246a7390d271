"""JDBC reads and writes. URL, user and password come from the caller only."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
) -> DataFrame:
    """A table or query. With a partition column it is read in ``partitions`` ranges."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def drop_internal(df: DataFrame) -> DataFrame:
    """Drops columns whose name starts with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def write_jdbc(
    df: DataFrame,
    table: str,
    options: Mapping[str, str],
    mode: str = "append",
    batch_size: int = 10_000,
    max_connections: int = 32,
) -> int:
    """Writes the rows and returns their number, counted while they are written.

    An overwrite truncates, so the table keeps its definition; an empty frame leaves an
    empty table. ``max_connections`` bounds the load on the database, whatever the
    size of the cluster.
    """
    written = Observation()
    (
        drop_internal(df)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", max_connections)
        .option("truncate", True)
        .mode(mode)
        .save()
    )
    return written.get["rows"]
