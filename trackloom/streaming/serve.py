"""Incremental serving: new files in, states and serving tables up to date."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.serving import SERVING_TABLES, ServingTable
from ..sinks import replace_batch, write_partitioned
from ..sources.files import read_optional


def store_batch(states: DataFrame, root: str, batch: str | int, replace_all: bool = False) -> None:
    """Stores unified states and their partial aggregates under the id of a batch.

    A batch that is repeated after a failure replaces its own rows and nothing else.
    ``replace_all`` drops every earlier batch, as a full load does.
    """

    def store(df: DataFrame, path: str) -> None:
        if replace_all:
            write_partitioned(df.withColumn("batch", F.lit(str(batch))), path, "overwrite", ("batch",))
        else:
            replace_batch(df, path, str(batch))

    store(states, f"{root}/states")
    stored = batch_states(states.sparkSession, root, batch, states.schema)
    for table in SERVING_TABLES:
        parts = table.partials(stored)
        if parts is not None:
            store(parts, f"{root}/partials/{table.name}")


def start_serving(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    normalize: Callable[[DataFrame], DataFrame] = lambda df: df,
    available_now: bool = True,
    every: str | None = None,
):
    """Takes in the files that arrived since the last run.

    The checkpoint is the ledger of the files read: a second run over the same files
    reads nothing. ``serving_table`` gives the current aggregates.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: store_batch(normalize(batch), root, batch_id)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def batch_states(spark: SparkSession, root: str, batch: str | int, schema: StructType) -> DataFrame:
    """The states stored under one batch id, whatever signs it has; maybe none."""
    layout = StructType([*schema.fields, StructField("batch", StringType())])
    rows = spark.read.schema(layout).parquet(f"{root}/states")
    return rows.filter(F.col("batch") == str(batch)).drop("batch")


def stored_states(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/states").drop("batch")


def serving_table(spark: SparkSession, root: str, table: ServingTable) -> DataFrame | None:
    """A serving table over all batches so far, merged from their partial rows."""
    parts = read_optional(spark, f"{root}/partials/{table.name}")
    return None if parts is None else table.finish(parts.drop("batch"))
