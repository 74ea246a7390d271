import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackloom.llm import quality
from trackloom.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark, sf_dir):
    out = LLM_QUERIES["op1_quality"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").toPandas()
    assert sorted(out.doc_id) == sorted(docs.doc_id)
    assert out.score.between(0, 1).all() and ((out.score >= 0.7) == (out.predicted == 1)).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() >= 0.9
    assert held[held.quality == 1].predicted.mean() >= 0.95


def test_model_without_one_class_or_any_row():
    text = "plain words of a text that is long enough " * 5
    assert quality.fit([]).intercept == 0.0
    only_good = quality.fit([(text, 1, 0), (text, 1, 1)])
    assert only_good.good is None and only_good.intercept > 0


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality.fit(quality.sample(docs, labels, rows=100))


def test_odd_rows(odd, no_docs, model):
    out = odd.withColumn("p", quality.score(F.col("text"), model)).select("text", "p").toPandas()
    assert len(out) == 14 and out.p.between(0, 1).all()
    empty = out[out.text.isna() | (out.text == "")].p
    assert empty.nunique() == 1
    assert out[out.text == "one"].p.nunique() == 1
    assert no_docs.withColumn("p", quality.score(F.col("text"), model)).count() == 0


def test_sample_leaves_out_contrary_and_null_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(0, 1), (0, 0), (1, 1), (1, 1), (2, 0), (3, None), (None, 1), (99, 0)], "doc_id long, quality int"
    )
    assert sorted((t, q) for t, q, _ in quality.sample(docs, labels)) == [("text 1", 1), ("text 2", 0)]
    assert len(quality.sample(docs, labels, rows=1)) == 2


def test_whole_text_counts(model):
    sizes = quality._Sizes(model)
    good = "Words of a usual text. " * 400
    assert sizes.measure(good) != sizes.measure(good[: quality.BLOCK_BYTES])
    assert sizes.measure(None) == sizes.measure("") == (0.0, 0.0)
    assert isinstance(pd.Series([sizes.measure(good)[0]])[0], float)


def test_scores_start_at_the_share_of_good_labels_and_move_with_length(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    share = quality.good_share(labels)
    model = quality.fit(quality.sample(docs, labels, rows=500), share=share)
    texts = [None, "", "a", "!!!!", "1234567890"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    out = frame.select(quality.score(F.col("text"), model).alias("p")).toPandas().p
    assert out[:2].nunique() == 1 and (out - share).abs().max() < 0.1


def test_calibration_by_length(spark, sf_dir):
    sf_dir = f"{os.path.dirname(sf_dir)}/sf0.1"  # a third of the held-out rows of a smaller table is 32 texts
    out = LLM_QUERIES["op1_quality"](spark, sf_dir).toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.length("text").alias("n")).toPandas()
    held = out[out.held_out].merge(labels, on="doc_id").merge(docs, on="doc_id")
    for _, part in held.groupby(pd.qcut(held.n, 3, duplicates="drop"), observed=True):
        assert abs(part.score.mean() - part.quality.mean()) < 0.06


def test_long_texts_are_learned_from(spark):
    docs = spark.createDataFrame([(1, "word " * 50_000), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert sorted((len(t), q) for t, q, _ in quality.sample(docs, labels)) == [(0, 0), (250_000, 1)]
