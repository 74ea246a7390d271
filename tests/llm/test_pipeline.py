"""Each stage against what it must do to its own input, and the whole run."""

import re

import pytest

import corpus_pipeline as pipeline
from trackloom.llm import packing, quality
from trackloom.llm.common import stored, words_of
from trackloom.llm.queries import GOOD_FROM, quality_model

NAMES = ["quality", "lines", "near duplicates", "decontamination", "packing"]


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The input of each stage and, last, the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), "step"))
    return out


def test_stages_in_order(steps):
    assert [n for n, _ in pipeline.STAGES] == NAMES
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_quality_keeps_what_scores_high(spark, sf_dir, steps):
    sizes, model = None, quality_model(spark, sf_dir)
    sizes = quality._Sizes(model)
    import numpy as np

    score = lambda t: 1 / (1 + np.exp(-(np.dot(sizes.measure(t), model.slopes) + model.intercept)))
    want = {d for d, t in rows(steps[0]) if score(t) >= GOOD_FROM}
    assert {d for d, _ in rows(steps[1])} == want


def test_lines_that_recur_are_left_once(steps):
    before, after = dict(rows(steps[1])), dict(rows(steps[2]))
    owners = {}
    for doc, text in after.items():
        for line in set(text.split("\n")):
            if len(line.split()) >= 4:
                owners.setdefault(line, set()).add(doc)
    assert max(map(len, owners.values())) == 1
    first = {}
    for doc in sorted(before):
        for line in before[doc].split("\n"):
            first.setdefault(line, doc)
    # a document whose lines are all its own, or first here, is untouched
    for doc, text in before.items():
        if all(first[x] == doc for x in text.split("\n")) and doc in after and after[doc] != text:
            assert any(len(x.split()) >= 8 for x in set(text.split("\n")) - set(after[doc].split("\n")))
    chars = {r.doc_id: (r.n_chars, r.text) for r in steps[2].collect()}
    assert all(n == len(t) for n, t in chars.values())


def test_one_document_of_each_class_stays(steps):
    def sets(df):
        out = {}
        for doc, text in rows(df):
            w = words_of(text)
            out[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        return out

    before, after = sets(steps[2]), set(d for d, _ in rows(steps[3]))
    where = {}
    for doc, s in before.items():
        for x in s:
            where.setdefault(x, set()).add(doc)
    for doc, s in before.items():
        near = {o for x in s for o in where[x] if o != doc}
        linked = {o for o in near if len(s & before[o]) >= 0.8 * len(s | before[o]) - 1e-9}
        if doc in after:
            assert not linked & after
        else:
            assert linked and min(linked) < doc


def test_leaks_go_and_the_rest_stays(spark, sf_dir, steps):
    plain = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {d for d, _ in rows(steps[4])}
    for doc, text in rows(steps[3]):
        words = plain(text)
        if any(i in words for i in items):
            assert doc not in kept
    gone = {d for d, _ in rows(steps[3])} - kept
    texts = dict(rows(steps[3]))
    for doc in gone:  # every document that went holds eight words in a row of some item
        words = plain(texts[doc])
        assert any(" ".join(i.split()[k : k + 8]) in words for i in items for k in range(len(i.split()) - 7))


def test_every_piece_is_packed(steps):
    out = steps[5].toPandas()
    words = {d: len(t.split()) + 1 for d, t in rows(steps[4])}
    assert out.groupby("doc_id")["size"].sum().to_dict() == words
    assert out.groupby("bin")["size"].sum().max() <= packing.CAPACITY


def test_run_is_the_stages(spark, sf_dir, steps):
    assert sorted(map(str, pipeline.run(spark, sf_dir).collect())) == sorted(map(str, steps[5].collect()))


def test_odd_rows_in_every_stage(spark, sf_dir, odd, no_docs):
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        if name != "packing":
            assert out.columns == odd.columns
        assert 0 < out.count() <= odd.count() + 20
        assert stage(spark, no_docs, sf_dir).count() == 0


def test_clean_texts_without_or_with_a_shared_id_stay(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    clean = "an unrelated note about the weather of the last days"
    docs = spark.createDataFrame([(None, item), (None, clean), (None, None), (7, item), (7, clean), (8, item)], "doc_id long, text string")
    kept = pipeline.drop_leaks(spark, docs, sf_dir)
    assert sorted(rows(kept), key=str) == sorted([(None, clean), (None, None), (7, clean)], key=str)


def test_short_lines_that_recur_are_left_once(spark, sf_dir):
    texts = ["All rights reserved.\nfirst own\n3", "second own\nAll  rights reserved.\n4", "All rights reserved.", "Chapter 1", "Chapter 2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = dict(rows(pipeline.drop_repeated_lines(spark, docs, sf_dir)))
    assert kept == {0: texts[0], 1: "second own\n4", 3: "Chapter 1", 4: "Chapter 2"}


def test_lines_of_texts_without_or_with_a_shared_id(spark, sf_dir):
    line = "this common line of text is in all of them"
    docs = [(None, f"{line}\nown {n} of these") for n in "abc"] + [(5, "x one of five y"), (5, "x one of five y\nmore of the same five")]
    kept = rows(pipeline.drop_repeated_lines(spark, spark.createDataFrame(docs, "doc_id long, text string"), sf_dir))
    assert sum(line in t for _, t in kept) == 1 and sum("own" in t for _, t in kept) == 3
    assert sum("x one of five y" in t for _, t in kept) == 1 and sum("more of the same five" in t for _, t in kept) == 1
