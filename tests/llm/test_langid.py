from itertools import product

import numpy as np
from pyspark.sql import functions as F

from trackloom.llm import langid
from trackloom.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark, sf_dir):
    out = LLM_QUERIES["op10_language"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(docs, on="doc_id")
    assert len(both) == len(docs) == len(out) and out.score.between(0, 1).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.97


def test_forward_backward_against_all_label_sequences():
    draw = np.random.default_rng(4)
    lengths = np.array([3, 1, 4])
    scores, transitions = draw.normal(size=(8, 3)), draw.normal(size=(3, 3))
    gamma, pairs = langid.forward_backward(scores, lengths, transitions, pairs=True)
    at, want_pairs = 0, np.zeros((3, 3))
    for n in lengths:
        total, mass, moves = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for y in product(range(3), repeat=int(n)):
            w = np.exp(sum(scores[at + t, y[t]] for t in range(n)) + sum(transitions[a, b] for a, b in zip(y, y[1:])))
            total += w
            for t in range(n):
                mass[t, y[t]] += w
            for a, b in zip(y, y[1:]):
                moves[a, b] += w
        assert np.allclose(gamma[at : at + n], mass / total)
        want_pairs += moves / total
        at += n
    assert np.allclose(pairs, want_pairs)


def test_words_change_language_inside_a_line():
    english = "the house and the garden are with this thing of that".split()
    german = "das haus und der garten sind mit dieser sache von ihnen".split()
    rows = [(" ".join(english[i:] + english[:i]), "en") for i in range(10)] + [(" ".join(german[i:] + german[:i]), "de") for i in range(10)]
    model = langid.fit(rows)
    labeller = langid.Labeller(model)
    words = english[:6] + german[:6]
    gamma = langid.forward_backward(labeller.look_up(words), np.array([12]), model.transitions)
    assert [model.languages[k] for k in gamma.argmax(axis=1)] == ["en"] * 6 + ["de"] * 6


def test_features_are_those_of_each_word_alone():
    lexicon = {"haus": 1}
    rows, owners = langid.features(["haus", "a", "über"], lexicon)
    for k, w in enumerate(["haus", "a", "über"]):
        alone, _ = langid.features([w], lexicon)
        assert sorted(rows[owners == k]) == sorted(alone)


def test_odd_rows(odd, no_docs):
    model = langid.fit([("the and of this that", "en"), ("und der die das mit", "de")])
    out = odd.select("text", langid.language(F.col("text"), model).alias("l")).toPandas()
    none = out.text.fillna("").str.contains("[^\\W\\d_]") == False  # noqa: E712
    assert {(l["lang"], l["score"]) for l in out[none].l} == {("und", 0.0)}
    assert {l["lang"] for l in out[~none].l} <= {"en", "de"}
    nothing = langid.fit([])
    assert {r.l.lang for r in odd.select(langid.language(F.col("text"), nothing).alias("l")).collect()} == {"und"}
    assert no_docs.select(langid.language(F.col("text"), model).alias("l")).count() == 0


def test_sample_is_bounded_and_leaves_out_the_held_fold(spark):
    rows = [(i, f"words number {i}", "en" if i % 3 else "de") for i in range(600)] + [(None, "x", "en"), (7000, None, "en"), (7001, "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample(df, rows=20, chars=8)
    assert sorted(x for _, x in got) == ["de"] * 20 + ["en"] * 20
    assert all(len(t) <= 8 for t, _ in got)
    assert langid.sample(df.where("false")) == []
