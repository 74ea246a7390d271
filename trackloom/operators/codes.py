"""Dictionaries from text to dense numbers, and exact distinct counts that merge.

A distinct count cannot be added up, a bitmap of the numbers seen can: bitmaps of two loads are
joined by ``or``. Numbers come from a dictionary that only grows, so a number means the same text in
every load.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 256


def new_codes(values: DataFrame, known: DataFrame | None, slots: int = SLOTS) -> DataFrame:
    """``value, code`` of the texts of a column ``value`` that ``known`` (value, code) does not have.

    Texts are dealt into slots by a hash and numbered inside their slot, behind those it holds, so no
    task sees all of them. Codes start at 1 and have few gaps, as slots fill evenly. Nulls get none.
    """
    fresh = values.select("value").filter(F.col("value").isNotNull()).distinct()
    slot = F.pmod(F.xxhash64("value"), F.lit(slots))
    if known is not None:
        fresh = fresh.join(known.select("value"), "value", "left_anti")
    placed = fresh.withColumn("slot", slot).withColumn(
        "place", F.row_number().over(Window.partitionBy("slot").orderBy("value")) - 1
    )
    if known is None:
        return placed.select("value", (F.col("place") * slots + F.col("slot") + 1).alias("code"))
    held = known.groupBy(F.pmod(F.col("code") - 1, F.lit(slots)).alias("slot")).agg(
        (F.max(F.floor((F.col("code") - 1) / slots)) + 1).alias("held")
    )
    place = F.col("place") + F.coalesce("held", F.lit(0))
    return placed.join(held, "slot", "left").select("value", (place * slots + F.col("slot") + 1).alias("code"))


def bitmap_group(code: Column | str) -> Column:
    """Which bitmap a code belongs to; one holds 32,768 codes."""
    return F.bitmap_bucket_number(code)


def bitmap_of(code: Column | str) -> Column:
    """Aggregate: the codes of one bitmap group as a bitmap."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(code))
