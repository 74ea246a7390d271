import re

from trackloom.llm import decontam
from trackloom.llm.queries import LLM_QUERIES

ITEM = "A train leaves the station with 120 passengers and Maria pays 15 dollars for a trip of 30 km to the old harbour."
SCHEMA = "doc_id long, text string"


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(spark, rows, *texts):
    out = decontam.leaks(spark.createDataFrame(rows, SCHEMA), items(spark, *texts)).collect()
    return {(r.doc_id, r.item_id): r for r in out}


def test_whole_items_in_given_documents(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet").toPandas() for t in ("documents", "benchmark"))
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = {i: f" {plain(t)} " for i, t in zip(docs.doc_id, docs.text)}
    want = {(i, k) for k, b in zip(bench.item_id, bench.text) for i, t in texts.items() if f" {plain(b)} " in t}
    got = {(r.doc_id, r.item_id) for r in LLM_QUERIES["op4_decontamination"](spark, sf_dir).collect()}
    assert want <= got
    assert {d for d, _ in got} == {d for d, _ in want}


def test_new_values_are_caught_if_consistent(spark):
    changed = ITEM.replace("120", "77").replace("Maria", "Tomas").replace("15 dollars", "9.50 euros").replace("30 km", "12 miles")
    got = found(spark, [(1, f"Intro words here. {ITEM} And more."), (2, f"see, {changed}"), (3, "a clean text about a train and its station")], ITEM)
    assert set(got) == {(1, 0), (2, 0)}
    assert not got[1, 0].reparameterised and got[2, 0].reparameterised
    assert got[2, 0].matched == got[2, 0].windows


def test_inconsistent_values_are_not_evidence(spark):
    item = "so 7 plus 7 plus 7 plus 7 plus 7 plus 7 plus 7 plus 7 equals the sum"
    same = item.replace("7", "5")
    mixed = "so 1 plus 2 plus 3 plus 4 plus 5 plus 6 plus 8 plus 9 equals the sum"
    got = found(spark, [(1, same), (2, mixed)], item)
    assert set(got) == {(1, 0)}


def test_short_items_and_windows_without_words(spark):
    got = found(spark, [(1, "we say blue harbour now"), (2, "1 2 3 4 5 6 7 8"), (3, "blue")], "blue harbour", "9 8 7 6 5 4", "blue", "")
    assert set(got) == {(1, 0)}


def test_half_of_an_item_is_needed(spark):
    words = ITEM.split()
    got = found(spark, [(1, " ".join(words[:16])), (2, " ".join(words[:8]))], ITEM)
    assert set(got) == {(1, 0)}


def test_canonical_words(spark):
    df = spark.createDataFrame([("In Rome, Maria paid 3,500.25 euros for 5kg. NASA x-ray!",)], "t string")
    row = df.select(decontam.template(df.t).alias("t"), decontam.words(df.t).alias("w")).first()
    assert len(row.t) == len(row.w)
    assert row.w[:5] == ["in", "\u0001rome", "\u0001maria", "paid", "\u00023,500.25"]
    assert row.t[4:6] == ["\u0002", "\u0003"] and "nasa" in row.t


def test_odd_rows(odd, no_docs, spark):
    bench = items(spark, ITEM, None, "")
    body = odd.where("doc_id = 5").first().text
    assert decontam.leaks(no_docs, bench).count() == 0
    assert decontam.leaks(odd, bench.where("false")).count() == 0
    both = bench.unionByName(items(spark, body).selectExpr("item_id + 10 as item_id", "text"))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(odd, both).collect()}
    assert got == {(5, 10), (6, 10), (None, 10)}
    kept = decontam.without_leaks(odd, both)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 3, 4, 7, 8, 9, 9]


def test_no_python_and_no_cross_join(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontam.leaks(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_words_and_template_have_the_same_places(spark):
    texts = ["he met Jean-Pierre and then", "at 50 km/h to the, Anna-Lena/Bo. 3-4 m/s. x-ray", "so Maria, then Anna.", "\u0001 a\u0002b ok"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select(decontam.template(df.t).alias("t"), decontam.words(df.t).alias("w")).collect():
        assert row.t == [w[0] if w[0] in "\u0001\u0002\u0003" else w for w in row.w]
    assert df.select(decontam.words(df.t)).first()[0] == ["he", "met", "\u0001jean-pierre", "and", "then"]


def test_values_behind_a_hyphenated_name_or_a_rate(spark):
    item = "so Maria gave apples to friends of Maria and bread to cousins of Maria but kept 12 pears for Maria at home"
    rows = [(1, f"he met Jean-Pierre there. {item}"), (2, f"we went at 50 km/h then. {item}"), (3, f"clean. {item}")]
    got = found(spark, rows, item)
    assert {k: (r.matched == r.windows, r.reparameterised) for k, r in got.items()} == {(d, 0): (True, False) for d in (1, 2, 3)}
    other = item.replace("Maria", "Jean-Pierre")
    got = found(spark, [(1, other), (2, f"at 50 km/h, {other}")], item)
    assert all(got[d, 0].matched == got[d, 0].windows and got[d, 0].reparameterised for d in (1, 2))
