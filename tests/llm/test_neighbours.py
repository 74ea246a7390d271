import numpy as np
import pytest

from trackloom.llm import neighbours
from trackloom.llm.queries import LLM_QUERIES


def brute(ids, x, q, k):
    s = x @ x[q]
    other = np.flatnonzero(ids != ids[q])
    best = other[np.lexsort((ids[other], -s[other]))[:k]]
    return ids[best].tolist(), s[best].tolist()


def test_recall_on_given_vectors(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = e.vec_id.to_numpy(), np.vstack(e.embedding.to_numpy()).astype(float)
    out = LLM_QUERIES["op6_neighbours"](spark, sf_dir).toPandas().sort_values(["query_id", "rank"])
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        own = out[out.query_id == ids[q]]
        want, _ = brute(ids, x, q, 20)
        assert own["rank"].tolist() == list(range(1, 21))
        assert own.score.is_monotonic_decreasing and not own.vec_id.duplicated().any()
        at = {i: n for n, i in enumerate(ids)}
        assert np.allclose(own.score, [x[at[v]] @ x[q] for v in own.vec_id], rtol=0, atol=1e-12)
        hit, total = hit + len(set(want) & set(own.vec_id)), total + 20
    assert hit / total >= 0.9


def test_perturbations_are_sets_in_order_of_cost():
    sets = neighbours.perturbations(4, 40)
    assert len({tuple(s) for s in sets}) == len(sets)
    assert not (sets & sets[:, ::-1]).any()
    assert sets[0].tolist() == [1, 0, 0, 0, 0, 0, 0, 0]
    # all sets of a single hash: -1 and +1, and no more
    assert len(neighbours.perturbations(1, 10)) == 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [3.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (1, [3.0, 0.0]), (40, None),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, bucket string")
    got = neighbours.nearest(df, df.vec_id % 20 == 0, k=3, width=100.0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 3.0), (0, 2, 2, 3.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0),
    ]
    assert neighbours.nearest(df.where("false"), df.vec_id % 20 == 0).count() == 0


def test_one_bucket_is_split(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 7)]) for i in range(400)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, df.vec_id % 20 == 0, k=5, width=1000.0, tables=2, hashes=2, group_rows=64).toPandas()
    x = np.array([[1.0, i % 7] for i in range(400)])
    for q, own in out.groupby("query_id"):
        want, score = brute(np.arange(400), x, q, 5)
        assert own.sort_values("rank").vec_id.tolist() == want and own.sort_values("rank").score.tolist() == score


@pytest.mark.parametrize("blocks", [{}, {"group_rows": 5, "query_rows": 2}])
def test_all_candidates_if_there_are_few(spark, blocks):
    x = np.random.default_rng(3).standard_normal((12, 64))
    ids = np.arange(12) * 10
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, df.vec_id % 20 == 0, **blocks).toPandas()
    for q in np.flatnonzero(ids % 20 == 0):
        want, score = brute(ids, x, q, 20)
        own = out[out.query_id == ids[q]].sort_values("rank")
        assert own.vec_id.tolist() == want and np.allclose(own.score, score, rtol=1e-12)
        assert own["rank"].tolist() == list(range(1, 12))


@pytest.mark.parametrize("length", [1e-200, 1e200, 5e-324])
def test_norms_whose_squares_are_no_doubles(spark, length):
    rows = [(0, [1.0, 0.0]), (1, [length, 0.0]), (2, [-length, 0.0]), (3, [0.0, length]), (20, [length, length])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, df.vec_id % 20 == 0).orderBy("query_id", "rank").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    with np.errstate(over="ignore"):
        for q in (0, 4):
            want, score = brute(ids, x, q, 20)
            assert [(r.vec_id, r.score) for r in out if r.query_id == ids[q]] == list(zip(want, score))


@pytest.mark.parametrize("norms", ["one long", "spread"])
def test_recall_with_unequal_norms(spark, sf_dir, norms):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = e.vec_id.to_numpy(), np.vstack(e.embedding.to_numpy()).astype(float)
    if norms == "one long":
        x[np.flatnonzero(ids % 20 != 0)[0]] *= 100
    else:
        x *= np.exp(0.7 * np.random.default_rng(1).standard_normal(len(x)))[:, None]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, df.vec_id % 20 == 0).toPandas()
    queries = np.flatnonzero(ids % 20 == 0)
    hit = sum(len(set(brute(ids, x, q, 20)[0]) & set(out[out.query_id == ids[q]].vec_id)) for q in queries)
    assert hit / (20 * len(queries)) >= 0.9
