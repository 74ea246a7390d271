"""What the operators share: tables, hold-out folds, column names, tables between steps."""

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id written as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def is_held_out(doc_id: Column) -> Column:
    """Fold 2 is never learned from. A null id is in no fold: neither learned from nor held out."""
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with a suffix if a column of any case has it already."""
    if name.lower() not in {c.lower() for c in df.columns}:
        return name
    return f"{name}_{uuid.uuid4().hex[:8]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join: broadcast if its counted rows are at most ``rows``, else left to a shuffle.

    ``df`` should be stored, or cheap, as counting runs it.
    """
    return F.broadcast(df) if df.count() <= rows else df


_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall(text.lower()) if text else []
