"""The operators as queries over the given tables, with production parameters.

Each query gets its rows through its operator and derives the columns it returns from them.
"""

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontam,
    jaccard,
    langid,
    lines,
    neighbours,
    packing,
    quality,
    runs,
    sharding,
    tokens,
    urls,
    variants,
)
from .common import is_held_out, stored, table

#: folder of the public tokenizers' vocabulary files; the driver reads the files and ships their bytes
TOKENIZERS = "/opt/tokenizers"
GOOD_FROM = 0.7


def ranks_file(folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken") -> bytes:
    """The vocabulary (under 1 MB) that tasks get with their function."""
    return Path(folder, name).read_bytes()


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    """Fitted on the given labels of documents outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = labels.where(~is_held_out(F.col("doc_id")))
    return quality.fit(quality.sample(docs, learned), share=quality.good_share(learned))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality_model(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = docs.withColumn("score", quality.score(F.col("text"), model)).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "lines", "dropped_lines", "text")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, 24).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packing.pack(docs).drop("text_hash")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similarity_classes(docs).select("doc_id", "class_id", "links")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.section_tokens(docs, ranks_file()).withColumn("tokens", F.col("tokens").cast("long"))


#: a conversation whose texts hold the template's own signs (fixed value)
ODD_TEXT = r"\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)], given.schema)
    return chat.digests(chat.format_conversations(given.unionByName(odd), ranks_file()))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.sample(docs.select("doc_id", "text", "lang")))
    found = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), langid.language(F.col("text"), model).alias("l"))
    return found.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))


def with_periods(doc_id: Column, text: Column) -> Column:
    """Every tenth text by the crc32 of its id continues, from some word on, with a period of words.

    The words of the other texts stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    given = F.struct(words.alias("w"), g.alias("g"))
    planted = F.transform(F.array(given), lambda x: _periodic(x["w"], x["g"]))[0]
    return F.when(h % 10 == 0, planted).otherwise(text)


def _periodic(words: Column, g: Column) -> Column:
    n = F.size(words)
    a = F.when(n > 0, g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i))), " ")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    given = docs.select("doc_id", with_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.repeated_runs(given)
    # exponents are compared exactly: a / b > c / d if a * d > c * b
    best = F.reduce(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged_words(docs: DataFrame) -> DataFrame:
    """Every word of the texts, one in 97 by a crc32 without one code point."""
    run = F.explode(variants.lowered_runs(F.col("text"))).alias("run")
    parts = docs.select(F.col("doc_id").cast("string").alias("id"), run).withColumn(
        "h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    )
    at = F.expr("cast(h % length(run) as int)")
    damaged = F.concat(F.left("run", at), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    return parts.select(F.when(F.col("h") % 97 == 0, damaged).otherwise(F.col("run")).alias("word"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = variants.word_counts(damaged_words(docs), 5, 3)
    return variants.variants(stored(counts, "words"), 2).select("word", "form", "root", "n", "n_near", "form_n")


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "weight")


LLM_QUERIES = {
    "op1_quality": op1_quality,
    "op2_lines": op2_lines,
    "op3_shards": op3_shards,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_neighbours": op6_neighbours,
    "op7_jaccard": op7_jaccard,
    "op8_tokens": op8_tokens,
    "op9_chat": op9_chat,
    "op10_language": op10_language,
    "op11_runs": op11_runs,
    "op12_variants": op12_variants,
    "op13_urls": op13_urls,
}
