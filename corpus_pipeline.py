"""From raw documents to packed sequences: stages over whole tables, each stored as Parquet.

Every stage takes the documents its predecessor kept, decides over all of them, and returns the
columns of ``documents``; the last returns the pieces of the packed sequences. A document's text
can lose lines in the second stage; ``n_chars`` is then counted again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import decontam, jaccard, lines, packing, quality
from trackloom.llm.common import fresh, stored, table
from trackloom.llm.queries import GOOD_FROM, quality_model


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents scored below ``GOOD_FROM`` go; the model is fitted on the given labels."""
    name = fresh(docs, "quality_score")
    scored = docs.withColumn(name, quality.score(F.col("text"), quality_model(spark, sf_dir)))
    return scored.where(F.col(name) >= GOOD_FROM).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: recurring lines go from all documents but the first that has them.

    The configuration is that of ``op2_lines``. Rows without id or with a shared one are documents
    of their own if their texts differ. A document of which no word is left goes too; documents
    without words to begin with stay.
    """
    cut = lines.dedup_lines(docs)
    dropped = [c for c in cut.columns if c not in docs.columns]
    emptied = (F.col(dropped[1]) > 0) & ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    kept = cut.where(~emptied)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        kept = kept.withColumn(
            "n_chars", F.when(F.col(dropped[1]) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return kept.select(*docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of documents linked by near-equal texts the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go, whatever values it was given.

    Rows are judged by their own texts, also if they have no id or share one.
    """
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), by_text=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: pieces of documents in bins of ``packing.CAPACITY`` words."""
    return packing.pack(docs).drop("text_hash")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("lines", drop_repeated_lines),
    ("near duplicates", one_of_each_class),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from ``documents``; every stage but the last is stored."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs


#: compression, MinHash and best-fit search have no SQL form; tests compare with brute force
ORACLE_SQL = None
PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
