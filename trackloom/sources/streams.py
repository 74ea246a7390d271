"""Stream readers."""

from pyspark.sql import DataFrame, SparkSession


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """A Kafka topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", fail_on_data_loss)
        .options(**options)
        .load()
    )


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Files as they arrive in a folder. The checkpoint remembers which were read."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
