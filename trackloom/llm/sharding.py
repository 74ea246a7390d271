"""Sharded global shuffle in two passes.

Pass 1 scatters the records by seeded hashes: a shard by highest random weight over the id, then
one of the shard's memory-sized buckets. The scattered records are stored on the shared folder.
Pass 2 takes one bucket per task into memory, shuffles it by Fisher-Yates and numbers it on from
the buckets before it.

Law ``key``: the shard depends on the id and the number of shards only; with one more shard, rows
move into the new one and nowhere else.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stored

BUCKET_BYTES = 8 << 20
#: up to so many hot records (16 bytes each) are broadcast; beyond, a shuffle join
BROADCAST_ROWS = 500_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose hash with the key is largest (ties: the larger shard number).

    A null key has a hash like any other value.
    """
    if shards == 1:
        return F.lit(0)
    weights = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(s)).alias("w"), F.lit(s).alias("s")) for s in range(shards)]
    return F.greatest(*weights)["s"]


def scatter(
    docs: DataFrame, shards: int, seed: int, key: str, text: str, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Pass 1: ``docs`` with ``size``, ``shard`` and ``bucket``, stored.

    The buckets of a shard are about ``bucket_bytes`` each. Rows that agree in id and text fall
    into one bucket and would not fit there if they were many; those with more copies than a
    hundredth of a bucket are spread by their position in the input as well.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    same = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    copies = max(1, bucket_bytes // 800)
    hot = docs.groupBy(same.alias("same")).count().where(F.col("count") > copies).select("same", F.lit(True).alias("hot"))
    hot = stored(hot, "hot")
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    place = F.when(F.col("hot"), F.xxhash64(F.col("same"), F.monotonically_increasing_id())).otherwise(F.col("same"))
    out = (
        docs.withColumn("same", same)
        .withColumn("size", size)
        .withColumn("shard", shard_of(F.col(key), shards, seed))
        .join(hot, "same", "left")
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), place), F.lit(buckets)))
        .drop("hot")
    )
    return stored(out, "scatter")


def shuffled(scattered: DataFrame, seed: int, key: str) -> DataFrame:
    """Pass 2: every row with its ``slot``, gapless from 0 in each shard, in a seeded random order."""
    counts = scattered.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    schema = T.StructType([*scattered.schema.fields, T.StructField("slot", T.LongType())])
    schema = T.StructType([f for f in schema.fields if f.name not in ("same", "bucket")])
    names = schema.names

    def fisher_yates(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        if not len(rows):
            return pd.DataFrame({n: [] for n in names})
        rows = rows.sort_values([key, "same"], kind="stable", na_position="last")
        bucket, shard = int(rows["bucket"].iloc[0]), int(rows["shard"].iloc[0])
        order = np.arange(len(rows))
        draw = np.random.default_rng([seed, shard, bucket])
        for last, other in zip(range(len(order) - 1, 0, -1), draw.integers(0, np.arange(len(order), 1, -1))):
            order[last], order[other] = order[other], order[last]
        rows = rows.iloc[order]
        return rows.assign(slot=np.arange(len(rows)) + int(start["start"].iloc[0]))[names]

    return (
        scattered.groupBy("shard", "bucket")
        .cogroup(starts.groupBy("shard", "bucket"))
        .applyInPandas(fisher_yates, schema)
    )


def shard(docs: DataFrame, shards: int, seed: int = 17, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Columns of ``docs`` with one of these names (or ``same``, ``bucket``) are renamed first. A null
    or empty text has 8 bytes and crc32 0; an empty table gives no rows.
    """
    made = ("same", "size", "shard", "bucket", "slot", "text_crc32", "law", "grown_shard", "hot", "count", "start")
    for c in docs.columns:
        if c.lower() in made:
            docs = docs.withColumnRenamed(c, fresh(docs, c))
    docs = docs.withColumns(
        {
            "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")),
            "law": F.lit("key"),
            "grown_shard": shard_of(F.col(key), shards + 1, seed),
        }
    )
    return shuffled(scatter(docs, shards, seed, key, text), seed, key)


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder ``shard=k`` for each shard; within a file rows are in the order of their slots.

    Files of one bucket of the shuffle hold consecutive slots.
    """
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
