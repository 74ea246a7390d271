import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import runs
from trackloom.llm.queries import with_periods


def brute(words, min_length=6, min_exponent=4):
    """Every period against every place."""
    found = {}
    n = len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, min_exponent * q):
                found.setdefault((start, i + q), q)
            i = max(i, start + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def drawn(draw):
    kind = draw.randrange(5)
    if kind == 0:
        return [draw.randrange(2) for _ in range(draw.randrange(70))]
    if kind == 1:
        return [draw.randrange(3) for _ in range(draw.randrange(40))] * draw.randrange(1, 7)
    if kind == 2:
        unit = [draw.randrange(4) for _ in range(draw.randrange(1, 9))]
        words = unit * draw.randrange(3, 12)
        words[draw.randrange(len(words))] = 9
        return words
    if kind == 3:
        inner = [draw.randrange(2) for _ in range(draw.randrange(1, 4))] * draw.randrange(4, 7) + [7]
        return inner * draw.randrange(1, 6)
    return [draw.randrange(30) for _ in range(draw.randrange(90))]


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (9, 3), (5, 6)])
def test_runs_against_all_periods(least):
    draw = random.Random(str(least))
    for _ in range(400):
        words = drawn(draw)
        assert runs.find_runs(np.array(words, dtype=np.int64), *least) == brute(words, *least), words


def test_long_runs_in_little_time():
    words = np.array(([1] * 30_000) + [2, 3] * 20_000 + list(range(10, 4_000)) * 5)
    assert runs.find_runs(words) == [(0, 30_000, 1), (30_000, 40_000, 2), (70_000, 19_950, 3_990)]


def test_chunks_keep_order():
    draw = random.Random(2)
    places = draw.sample(range(100_000), 12_000)
    kept = runs._Places(places[0])
    for k, p in enumerate(places[1:], 1):
        if k % 500 == 0:
            before = [x for x in places[:k] if x < p]
            behind = [x for x in places[:k] if x > p]
            assert kept.around(p) == (max(before, default=-1), min(behind, default=-1))
        kept.add(p)
    assert list(kept) == sorted(places) and kept.size == len(places) and len(kept.chunks) > 2


def test_texts_and_collapse(spark):
    texts = [
        "x " + "so it goes " * 5 + "on",
        "la la la la la la",
        "la la la la la",  # five words are no run
        "\u00a0a\u00a0 b\x1c b\x1c\tb\x1c\nb\x1c b\x1c b\x1c end",  # only six ASCII signs part words
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in runs.repeated_runs(df).collect()}
    assert [tuple(x) for x in out[0].runs] == [(1, 15, 3)] and out[0].collapsed == "x so it goes on"
    assert [tuple(x) for x in out[1].runs] == [(0, 6, 1)] and out[1].collapsed == "la"
    assert out[2].runs == [] and out[2].collapsed == texts[2]
    assert [tuple(x) for x in out[3].runs] == [(1, 6, 1)] and out[3].collapsed == "\u00a0a\u00a0 b\x1c end"
    with pytest.raises(ValueError):
        runs.repeated_runs(df, min_exponent=1)


def test_batches_by_size(spark, monkeypatch):
    df = spark.createDataFrame([(k, "a b c d " * (k % 7)) for k in range(60)], "doc_id long, text string")
    want = sorted(map(str, runs.repeated_runs(df).collect()))
    monkeypatch.setattr(runs, "BATCH_CHARS", 25)
    assert sorted(map(str, runs.repeated_runs(df.coalesce(1)).collect())) == want


def test_planted_periods(spark):
    """The words of every tenth text, placed one by one."""
    import zlib

    rows = [(k, " ".join(f"w{j}" for j in range(k % 23))) for k in range(300)] + [(None, "a b"), (7, None), (9, " ")]
    out = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", with_periods(F.col("doc_id"), F.col("text")))
    for r in out.collect():
        words = (r.text or "").split()
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert (r.t or "").split() == words


def test_odd_rows(odd, no_docs):
    out = runs.repeated_runs(odd).toPandas()
    assert len(out) == 14 and out.doc_id.isna().sum() == 2
    assert (out[out.doc_id.isin([1, 2, 3])].words == 0).all() and (out[out.doc_id.isin([1, 2, 3])].collapsed == "").all()
    assert out[out.doc_id == 4].words.tolist() == [30_000]
    assert runs.repeated_runs(no_docs).count() == 0
