import random

from trackloom.llm import packing
from trackloom.llm.queries import LLM_QUERIES


def test_best_fit_takes_the_tightest_compatible_bin():
    # 60 and 50 open bins with room 40 and 50; 40 of source a conflicts with the tighter bin
    got = packing.best_fit([60, 50, 40, 35], ["a", "b", "a", None], [None] * 4, 100)
    assert got == [(0, 0, 0), (1, 0, 0), (1, 1, 50), (0, 1, 60)]
    # copies never share a bin, though their sources differ
    assert [b for b, *_ in packing.best_fit([10, 10, 10], ["a", "b", "c"], [7, 7, None], 100)] == [0, 1, 0]


def brute(sizes, sources, clusters, capacity):
    bins = []
    out = []
    for s, src, cl in zip(sizes, sources, clusters):
        fit = [
            (capacity - sum(x[0] for x in b), n)
            for n, b in enumerate(bins)
            if sum(x[0] for x in b) + s <= capacity
            and all((src is None or x[1] != src) and (cl is None or x[2] != cl) for x in b)
        ]
        n = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([])
        bins[n].append((s, src, cl))
        out.append(n)
    return out


def test_best_fit_is_the_plain_rule():
    draw = random.Random(3)
    for _ in range(30):
        n = draw.randint(1, 120)
        sizes = sorted((draw.randint(1, 100) for _ in range(n)), reverse=True)
        sources = [draw.choice(["a", "a", "a", "b", "c", None]) for _ in range(n)]
        clusters = [draw.choice([1, 2, None, None, None]) for _ in range(n)]
        got = packing.best_fit(sizes, sources, clusters, 100)
        assert [b for b, *_ in got] == brute(sizes, sources, clusters, 100)


def valid(out, docs, capacity):
    words = docs.text.fillna("").str.split().str.len() + 1
    assert out["size"].sum() == words.sum()
    by_bin = out.groupby("bin")
    assert by_bin["size"].sum().max() <= capacity
    for _, b in by_bin:
        b = b.sort_values("position")
        assert b.position.tolist() == list(range(len(b)))
        assert b["at"].tolist() == [0, *b["size"].cumsum()[:-1]]


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").toPandas()
    out = LLM_QUERIES["op5_packing"](spark, sf_dir).toPandas()
    valid(out, docs, packing.CAPACITY)
    both = out.merge(docs, on="doc_id")
    assert not both.duplicated(["bin", "source"]).any() and not both.duplicated(["bin", "text"]).any()
    per_doc = out.sort_values("piece").groupby("doc_id")
    assert (per_doc["start"].apply(list) == per_doc["size"].apply(lambda s: [0, *s.cumsum()[:-1]])).all()


def test_texts_come_back(spark, odd, no_docs):
    packed = packing.pack(odd, capacity=50)
    valid(packed.toPandas(), odd.toPandas(), 50)
    texts = packing.sequences(packed, odd).collect()
    assert len(texts) == packed.select("bin").distinct().count()
    assert sum(len(t.text.split()) for t in texts) == packed.agg({"size": "sum"}).first()[0]
    assert packing.pack(no_docs).count() == 0


def test_many_equal_rows_are_spread(spark):
    docs = spark.createDataFrame([(1, "same text", "a")] * 300, "doc_id long, text string, source string")
    out = packing.pack(docs, capacity=10, group_rows=50).toPandas()
    assert len(out) == 300 and out.bin.nunique() == 300 and (out.bin // 2**32).nunique() > 1
