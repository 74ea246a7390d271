import random
from collections import defaultdict

import numpy as np
import pytest

from trackloom.llm import jaccard
from trackloom.llm.common import words_of
from trackloom.llm.components import components
from trackloom.llm.queries import LLM_QUERIES


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {("", text)}


def brute(rows):
    """[(doc, class, links)] by exact comparison of all pairs that share a shingle."""
    sets = [None if t is None else shingles(t) for _, t in rows]
    where = defaultdict(list)
    near = defaultdict(set)
    for n, s in enumerate(sets):
        for x in s or ():
            where[x].append(n)
    for group in where.values():
        for i in group:
            near[i].update(group)
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for i in range(len(rows)):
        for j in near[i]:
            if i < j:
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    root[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            low[top(n)] = min(low.get(top(n), doc), doc)
    return [(doc, low.get(top(n)) if t is not None else doc, links[n]) for n, (doc, t) in enumerate(rows)]


def same(got, rows):
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = LLM_QUERIES["op7_jaccard"](spark, sf_dir).collect()
    same(got, rows)
    assert sum(r.links > 0 for r in got) > 50


@pytest.fixture(scope="module")
def family(spark):
    """A large family of different near copies, chains of edits, and texts with a common half."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = []
    for n in range(150):
        own = list(base)
        own[draw.randrange(120)] = word()
        rows.append((n, " ".join(own)))
    chain = list(base)
    for n in range(150, 190):
        for _ in range(2):
            chain[draw.randrange(120)] = word()
        rows.append((n, " ".join(chain)))
    half = [word() for _ in range(60)]
    rows += [(n, " ".join(half + [word() for _ in range(60)])) for n in range(190, 260)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block", [16, 256])
def test_family_in_blocks(family, block):
    rows, df = family
    same(jaccard.similarity_classes(df, block=block).select("doc_id", "class_id", "links").collect(), rows)


def test_odd_rows(odd, no_docs):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    same(jaccard.similarity_classes(odd).select("doc_id", "class_id", "links").collect(), rows)
    assert jaccard.similarity_classes(no_docs).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    got = sorted(((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()), key=str)
    texts = dict(rows)
    want = [(1, None), (2, ""), (3, texts[3]), (4, texts[4]), (5, texts[5]), (None, None), (7, "!!! ???"), (8, "one"), (9, rows[-1][1])]
    assert got == sorted(want, key=str)
    assert jaccard.one_of_each(no_docs).count() == 0


def test_minhash_estimates_similarity():
    s = jaccard.Shingler()
    draw = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        x = draw.integers(0, 2**63, 400).astype(np.uint64)
        common = draw.integers(100, 400)
        y = np.concatenate([x[:common], draw.integers(0, 2**63, 400 - common).astype(np.uint64)])
        errors.append((s.signature(np.unique(x)) == s.signature(np.unique(y))).mean() - common / (800 - common))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_pruning_bounds_follow_the_posterior():
    least = jaccard.least_matches()
    assert list(least) == list(range(16, 129, 16))
    assert all(0 < m < 0.8 * n for n, m in least.items())
    draw = np.random.default_rng(2)
    tried = draw.random((20_000, 128)) < 0.8
    lost = np.zeros(20_000, dtype=bool)
    for n, m in least.items():
        lost |= tried[:, :n].sum(axis=1) < m
    assert lost.mean() <= 1e-3


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 20), (5, 4), (30, 1), (7, 9)]
    df = spark.createDataFrame(edges, "u long, v long")
    assert sorted(map(tuple, components(df).collect())) == [
        (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (7, 7), (8, 7), (9, 7), (30, 1),
    ]
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    assert components(chain).where("component = 0").count() == 301
    assert components(df.where("false")).count() == 0


def test_rows_without_id_are_read_once_each(spark, monkeypatch):
    draw = random.Random(3)
    base = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(80)]
    rows = [(None, " ".join([*base[:n], "other", *base[n + 1 :]])) for n in range(60)]
    rows += [rows[0]] * 40 + [(3, rows[1][1]), (3, rows[2][1])]
    seen, real = spark.sparkContext.accumulator(0), jaccard._only_own

    def counted(sets):
        run = real(sets)

        def over(batches):
            def look(batch):
                seen.add(len(batch))
                return batch

            return run(look(b) for b in batches)

        return over

    monkeypatch.setattr(jaccard, "_only_own", counted)
    for bound in (jaccard.BROADCAST_ROWS, 0):
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", bound)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        same(jaccard.similarity_classes(df).select("doc_id", "class_id", "links").collect(), rows)
    assert seen.value == 2 * 60
