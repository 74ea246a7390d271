import zlib

from trackloom.llm import sharding
from trackloom.llm.queries import LLM_QUERIES


def check(out, docs, shards):
    assert len(out) == len(docs)
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert out.shard.between(0, shards - 1).all()
    assert ((out.grown_shard == out.shard) | (out.grown_shard == shards)).all()
    for text, size, crc in zip(out.text, out["size"], out.text_crc32):
        raw = (text or "").encode()
        assert size == len(raw) + 8 and crc == zlib.crc32(raw)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    out = LLM_QUERIES["op3_shards"](spark, sf_dir).toPandas()
    check(out.merge(docs, on="doc_id"), docs, 24)
    assert out.shard.nunique() == 24 and (out.law == "key").all()
    again = LLM_QUERIES["op3_shards"](spark, sf_dir).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert out[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_order_is_shuffled_in_many_buckets(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    scattered = sharding.scatter(docs, 3, 17, "doc_id", "text", bucket_bytes=4_000)
    assert scattered.select("shard", "bucket").distinct().count() >= 10
    out = sharding.shuffled(scattered, 17, "doc_id").toPandas().sort_values(["shard", "slot"])
    for _, part in out.groupby("shard"):
        assert part.slot.tolist() == list(range(len(part)))
        up = (part.doc_id.diff().dropna() > 0).mean()
        assert 0.4 < up < 0.6


def test_many_copies_of_one_row_do_not_meet(spark):
    docs = spark.createDataFrame([(1, "same")] * 500 + [(i, "x" * 50) for i in range(200)], "doc_id long, text string")
    scattered = sharding.scatter(docs, 2, 17, "doc_id", "text", bucket_bytes=1_600)
    largest = scattered.where("doc_id = 1").groupBy("bucket").count().agg({"count": "max"}).first()[0]
    assert largest < 400
    out = sharding.shuffled(scattered, 17, "doc_id").toPandas()
    assert len(out) == 700 and all(sorted(p.slot) == list(range(len(p))) for _, p in out.groupby("shard"))


def test_odd_rows(odd, no_docs, tmp_path):
    out = sharding.shard(odd, 4)
    check(out.toPandas(), odd.toPandas(), 4)
    assert sharding.shard(no_docs, 4).count() == 0
    sharding.write_shards(out.select("doc_id", "text", "shard", "slot"), str(tmp_path / "shards"))
    assert odd.sparkSession.read.parquet(str(tmp_path / "shards")).count() == odd.count()
