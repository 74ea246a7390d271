import random

import numpy as np
import pytest

from trackloom.llm import tokens
from trackloom.llm.queries import LLM_QUERIES, ranks_file


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.Vocabulary(ranks_file())


def brute(edges, spans, rule):
    """Byte by byte."""
    owner = {}
    for k, (a, b) in enumerate(spans):
        for x in range(a, b):
            owner[x] = k
    counts, rest = [0.0] * len(spans), 0.0
    for a, b in zip(edges[:-1], edges[1:]):
        at = [owner.get(x) for x in range(a, b)]
        if rule == "share":
            for k in at:
                if k is None:
                    rest += 1 / len(at)
                else:
                    counts[k] += 1 / len(at)
            continue
        if rule == "most":
            inside = [k for k in at if k is not None]
            k = max(sorted(set(inside)), key=inside.count) if inside else None
        else:
            k = at[0] if rule == "first" else at[-1]
        if k is None:
            rest += 1
        else:
            counts[k] += 1
    return counts, rest


@pytest.mark.parametrize("rule", tokens.RULES)
def test_rules_byte_by_byte(rule):
    draw = random.Random(9)
    for _ in range(150):
        edges = np.concatenate([[0], np.cumsum([draw.randint(1, 6) for _ in range(draw.randint(0, 25))])]).astype(int)
        cuts = sorted(draw.randint(0, int(edges[-1])) for _ in range(2 * draw.randint(0, 6)))
        spans = list(zip(cuts[::2], cuts[1::2]))
        a, b = (np.array([s[k] for s in spans], dtype=np.int64) for k in (0, 1))
        counts, rest = tokens.attribute(edges, a, b, rule)
        if rule != "share" and len(set(a)) < len(a):
            counts, want = sorted(counts), brute(edges, spans, rule)
            assert counts == pytest.approx(sorted(want[0])) and rest == pytest.approx(want[1])
            continue
        assert (list(counts), rest) == (pytest.approx(brute(edges, spans, rule)[0]), pytest.approx(brute(edges, spans, rule)[1]))


def test_given_documents(spark, sf_dir, vocabulary):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    out = LLM_QUERIES["op8_tokens"](spark, sf_dir).toPandas().sort_values(["doc_id", "section"])
    assert set(out.doc_id) == set(docs)
    for doc, own in out.groupby("doc_id"):
        text = docs[doc]
        ids = vocabulary.encoding.encode_ordinary(text)
        assert vocabulary.encoding.decode(ids) == text
        assert own.tokens.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        assert "".join(text[a:b] for a, b in zip(own.start, own.end)) == text


def test_given_sections_in_characters(spark, vocabulary):
    text = "Überschrift\nein Satz über Öl 🙂 und mehr"
    spans = [(0, 11), (12, 20), (18, 30), (100, 200), (None, None)]
    df = spark.createDataFrame([(1, text, spans)], "doc_id long, text string, parts array<struct<start:int,end:int>>")
    for rule in tokens.RULES:
        out = {r.section: r for r in tokens.section_tokens(df, ranks_file(), sections="parts", rule=rule).collect()}
        total = len(vocabulary.encoding.encode_ordinary(text))
        assert sum(r.tokens for r in out.values()) == pytest.approx(total)
        assert (out[1].start, out[1].end, out[2].start, out[2].end) == (12, 20, 20, 30)
        assert out[3].tokens == 0 and -1 in out
    with pytest.raises(ValueError):
        tokens.section_tokens(df, ranks_file(), rule="none")


def test_odd_rows(odd, no_docs):
    out = tokens.section_tokens(odd, ranks_file()).toPandas()
    assert out.doc_id.isna().sum() == 2
    assert (out.groupby("doc_id", dropna=False).tokens.sum().loc[[1, 2]] == 0).all()
    assert (out.doc_id == 2).sum() == 2
    assert tokens.section_tokens(no_docs, ranks_file()).count() == 0
