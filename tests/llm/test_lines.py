import re
from collections import defaultdict

from pyspark.sql import functions as F

from trackloom.llm import lines


def brute(rows, min_tokens=4, min_docs=2, similarity=0.8):
    """Every line against every other of its length: {(doc, text): (lines, dropped, text)}."""
    parsed = []
    for doc, text in rows:
        for n, line in enumerate(text.split("\n") if text is not None else []):
            own = tuple(line.split())
            masked = tuple("<*>" if re.search("[0-9]", t) else t for t in own)
            if own:
                parsed.append((doc, text, n, own if len(own) < min_tokens else masked))
    different = sorted({t for *_, t in parsed})
    template = {t: t for t in different}

    def root(t):
        while template[t] != t:
            t = template[t]
        return t

    sizes = defaultdict(list)
    for t in different:
        sizes[len(t)].append(t)
    for n, members in sizes.items():
        block = int(n * (1 - similarity) + 1e-9)
        firsts = {}
        for t in members if block else []:
            for at in range(0, n, block):
                other = firsts.setdefault((at, t[:at], t[at + block:]), t)
                template[root(t)] = root(other)
    docs = defaultdict(set)
    order = lambda d: (d is None, d)
    for doc, text, _, t in parsed:
        docs[root(t)].add((order(doc), text))
    drops = defaultdict(set)
    for doc, text, n, t in parsed:
        d = docs[root(t)]
        if len(d) >= min_docs and (order(doc), text) != min(d):
            drops[doc, text].add(n)
    out = []
    for doc, text in rows:
        own = [] if text is None else text.split("\n")
        gone = drops[doc, text] if text is not None else set()
        kept = None if text is None else "\n".join(x for n, x in enumerate(own) if n not in gone)
        out.append((doc, len(own), len(gone), kept))
    return out


def compare(docs, **how):
    got = [tuple(r) for r in lines.dedup_lines(docs, **how).select("doc_id", "lines", "dropped_lines", "text").collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(brute(rows, **how), key=key)
    return got


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert sum(r[2] for r in compare(docs)) > 100


def test_templates_with_fields(spark):
    rows = [
        (1, "Order 17 was sent to Anna on 2020-01-02 from Rome today\nkeep this line of text"),
        (2, "Order 18 was sent to Bert on 2021-11-30 from Rome today\nanother line of own text"),
        (3, "Order 99 was sent to Cleo on 2022-05-06 from Rome today\n\nshort one\nshort one"),
        (4, "Order 5 is something else altogether and is kept whole here"),
    ]
    got = {r[0]: r for r in compare(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert [got[d][2] for d in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert got[3][3] == "\nshort one\nshort one"


def cased(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_edits_of_one_line(spark):
    """A line of 21 words and nine copies with one word changed, each at another place."""
    line = [f"word{chr(97 + k)}" for k in range(21)]
    texts = [" ".join(line)]
    for k in range(9):
        edited = list(line)
        edited[2 * k] = f"other{chr(97 + k)}"
        texts.append(" ".join(edited))
    for order in (texts, texts[::-1], texts[5:] + texts[:5]):
        got = sorted(compare(cased(spark, order)))
        assert [r[2] for r in got] == [0] + [1] * 9


def test_two_fields_of_one_template(spark):
    """A grid of names and sections, with the first field among the leading words."""
    texts = [f"Posted by {a} in the well kept archive of {b}" for a in ("Anna", "Bert", "Cleo") for b in ("Rome", "Oslo", "Graz")]
    for order in (texts, [texts[k] for k in (0, 4, 8, 1, 5, 6, 2, 3, 7)]):
        assert [r[2] for r in sorted(compare(cased(spark, order)))] == [0] + [1] * 8


def test_lines_that_share_too_little_stay(spark):
    texts = [
        "one two three four", "one two three five",  # four words have no field
        "a b c d e f g", "a b c d e x y",  # two of seven words
        "p q r s t u v w x y", "p q z s t u v z x y",  # two of ten words, in two blocks
        "k l m n o", "k l m n",
    ]
    assert not any(r[2] for r in compare(cased(spark, texts)))


def test_short_lines_are_compared_as_they_are(spark):
    got = sorted(compare(cased(spark, ["page 1\nAll rights reserved.", "page 2\nAll rights reserved.", "page 1\n\nend"])))
    assert [(r[2], r[3]) for r in got] == [(0, "page 1\nAll rights reserved."), (1, "page 2"), (1, "\nend")]


def test_rows_without_an_id_are_documents_of_their_own(spark):
    rows = [(None, "a line that is there twice\nx"), (None, "a line that is there twice\ny"), (3, "a line that is there twice\nz")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.dropped_lines, r.text.split("\n")[-1]) for r in got.collect()) == [(0, "z"), (1, "x"), (1, "y")]


def test_three_documents_needed(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 3 = 0").select("doc_id", "text")
    compare(docs, min_docs=3)


def test_both_ways_of_the_joins_agree(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 4 = 0").select("doc_id", "text")
    monkeypatch.setattr(lines, "BROADCAST_LEAVES", 0)
    compare(docs)


def test_odd_rows(odd, no_docs):
    out = lines.dedup_lines(odd)
    assert out.count() == odd.count()
    assert set(odd.columns) < set(out.columns) and len(out.columns) == len(odd.columns) + 2
    plain = odd.select("doc_id", "text")
    compare(plain)
    assert lines.dedup_lines(no_docs.select("doc_id", "text")).count() == 0


def test_no_python_and_no_cross_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_long_words_without_digits_are_quick(spark):
    text = "a" * 300_000 + " b c d\n" + "w " * 100_000
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    out = lines.dedup_lines(docs).orderBy("doc_id").select("dropped_lines", F.length("text").alias("n")).collect()
    assert [tuple(r) for r in out] == [(0, len(text)), (2, 0)]
