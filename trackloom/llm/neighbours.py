"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector to ``HASHES`` integers ``floor((a.x + b) / width)`` with
normal ``a``. Inner products are searched as distances: vectors are divided by the largest norm
of their band and get one more component that makes their norm 1, queries are made unit vectors.
Norms of a band differ by a factor of ``BAND`` at most, so a long vector does not shrink the
others; all bands share the hash functions and buckets, so one visit meets the vectors of all. The
nearest are then no longer those at the smallest angle, so queries visit more buckets: up to twice
as many, by the share of vectors outside the commonest band. A query visits
its own bucket and then perturbed ones in the estimated order of success, by the squared distances
to the borders that a perturbation crosses. Candidates of all tables are ranked by their exact
inner product.

Buckets are dealt into groups by a hash; a group holds about ``GROUP_ROWS`` entries, and a bucket
with more than that is split. The queries of a group are split as well, into blocks of about
``QUERY_ROWS`` by the share of queries that its entries let expect. A task has a part of the entries of
one group and a block of the probes that go there, and returns at most ``k`` candidates for each query, so
nothing grows with a bucket. Queries that found fewer than ``k`` are compared with all vectors, in blocks.

Lengths are kept as logarithms, so norms beyond what a double holds, or whose squares are, hash like any
others. A score is the plain inner product in double precision all the same and can be 0 or infinite there.

Vectors that are null, empty or zero, have a null or non-finite component, or another length than
the commonest (ties: the longer), take no part; nor do rows without an id. Rows that agree in id
and vector are one candidate; a query is never a candidate of its own id. An empty table gives no rows.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TABLES, HASHES, WIDTH, PROBES = 16, 12, 2.5, 220
GROUP_ROWS = 262_144
QUERY_ROWS = 8_192
BAND = 1.1
_SEED = 4_099


def usable(vector: Column) -> Column:
    """All components there and finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def log_norm(vector: Column) -> Column:
    """Logarithm of the Euclidean norm; where squares would leave the doubles, of the scaled vector."""
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x)
    top = F.array_max(F.transform(vector, F.abs))
    scaled = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (x / top) * (x / top))
    return F.when(squares.between(1e-200, 1e200), F.log(squares) / 2).otherwise(F.log(top) + F.log(scaled) / 2)


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their norms, and the logarithms of the norms."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    norm = np.sqrt((x**2).sum(axis=1, keepdims=True))
    return x / norm, (np.log(top) + np.log(norm))[:, 0]


class Tables:
    """The hash functions; the same in every task."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float):
        draw = np.random.default_rng([_SEED, dim, tables, hashes])
        self.a = draw.standard_normal((dim + 1, tables * hashes))
        self.b = draw.random(tables * hashes) * width
        self.shape, self.width = (tables, hashes), width
        self.mix = draw.integers(1, 2**63, size=(tables, hashes), dtype=np.int64) | 1
        self.salt = draw.integers(0, 2**62, size=tables, dtype=np.int64)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket numbers (rows, tables) and the place inside the bucket (rows, tables, hashes)."""
        h = ((x @ self.a + self.b) / self.width).reshape(len(x), *self.shape)
        cell = np.floor(h)
        return self.code(cell.astype(np.int64)), h - cell

    def code(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.mix).sum(axis=-1) + self.salt

    def visits(self, own: np.ndarray, inside: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """Buckets that queries visit, the likeliest of each table first (rows, tables, 1 + sets)."""
        cost = np.concatenate([inside, 1 - inside], axis=2)
        steps = np.broadcast_to(np.concatenate([-self.mix, self.mix], axis=1), cost.shape)
        steps = np.take_along_axis(steps, np.argsort(cost, axis=2, kind="stable"), axis=2)
        with np.errstate(over="ignore"):
            return np.concatenate([own[..., None], own[..., None] + steps @ sets.T], axis=2)


def perturbations(hashes: int, count: int) -> np.ndarray:
    """The ``count`` likeliest sets of steps, as 0/1 over the steps sorted by distance to the border.

    With places uniform in their buckets, the squared distance of the j-th nearest of the 2M
    borders has the expectation used here; a set's cost is the sum, and cheap sets succeed more
    often. Steps j and 2M + 1 - j move the same hash, so a set never has both.
    """
    m, cost = hashes, []
    for j in range(1, 2 * m + 1):
        if j <= m:
            cost.append(j * (j + 1) / (4 * (m + 1) * (m + 2)))
        else:
            r = 2 * m + 1 - j
            cost.append(1 - r / (m + 1) + r * (r + 1) / (4 * (m + 1) * (m + 2)))
    found: list[tuple[int, ...]] = []
    heap = [(cost[0], (0,))]
    while heap and len(found) < count:
        total, chosen = heapq.heappop(heap)
        if not any(2 * m - 1 - c in chosen for c in chosen):
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    sets = np.zeros((len(found), 2 * m), dtype=np.int64)
    for row, chosen in enumerate(found):
        sets[row, list(chosen)] = 1
    return sets


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec: str = "vec_id",
    embedding: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
    group_rows: int = GROUP_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its best candidates, the nearest first.

    ``score`` is the inner product of the original vectors in double precision; ties go to the
    smaller id. With fewer than ``k`` candidates in the table a query gets all of them; without one
    it gives no row.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec).cast("long").alias("id"),
        F.col(embedding).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    ).where(usable(F.col("v")) & F.col("id").isNotNull())
    normed = rows.select(F.size("v").alias("dim"), "q", log_norm(F.col("v")).alias("norm"))
    bands = normed.groupBy("dim", F.floor(F.col("norm") / np.log(BAND).item() + 0.5).alias("band")).agg(
        F.count("*").alias("n"), F.count_if("q").alias("queries"), F.max("norm").alias("norm")
    )
    dims = bands.groupBy("dim").agg(
        F.sum("n").alias("n"),
        F.sum("queries").alias("queries"),
        F.max("n").alias("most"),
        F.array_sort(F.collect_list("norm")).alias("norms"),
    )
    shape = dims.orderBy(F.desc("n"), F.desc("dim")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], result)
    dim, scales = shape.dim, np.array(shape.norms)
    probes = round(probes * (2 - shape.most / shape.n))
    groups = max(1, -(-shape.n * tables // group_rows))
    rows = rows.where(F.size("v") == dim).groupBy("id", "v").agg(F.max("q").alias("q"))
    sets = perturbations(hashes, probes - 1)

    def by_group(ids: pd.Series, vectors: pd.Series, codes: np.ndarray) -> pd.DataFrame:
        """A row for each vector and group: the vector's buckets in that group travel with one copy of it."""
        row = np.repeat(np.arange(len(codes)), codes.shape[1])
        bucket = codes.ravel()
        mixed = bucket.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        group = ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((group, row))
        row, group, bucket = row[order], group[order], bucket[order]
        cut = np.flatnonzero(np.diff(row * groups + group)) + 1
        first = np.concatenate([[0], cut])
        return pd.DataFrame(
            {
                "id": ids.to_numpy()[row[first]],
                "v": vectors.to_numpy()[row[first]],
                "buckets": np.split(bucket, cut),
                "group": group[first],
            }
        )

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lsh = Tables(dim, tables, hashes, width)
        for batch in batches:
            if not len(batch):
                continue
            x = np.vstack(batch["v"].to_numpy())
            x, length = unit(x)
            own = np.minimum(np.searchsorted(scales, length - 1e-9), len(scales) - 1)
            x *= np.exp(length - scales[own])[:, None]
            rest = np.sqrt(np.maximum(0.0, 1 - (x**2).sum(axis=1, keepdims=True)))
            codes, _ = lsh.place(np.hstack([x, rest]))
            yield by_group(batch["id"], batch["v"], codes)

    def probing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lsh = Tables(dim, tables, hashes, width)
        for batch in batches:
            if not len(batch):
                continue
            x, _ = unit(np.vstack(batch["v"].to_numpy()))
            codes, inside = lsh.place(np.hstack([x, np.zeros((len(x), 1))]))
            for at in range(0, len(x), 256):
                part = slice(at, at + 256)
                visits = lsh.visits(codes[part], inside[part], sets).reshape(len(x[part]), -1)
                yield by_group(batch["id"][part], batch["v"][part], visits)

    schema = "id long, v array<double>, buckets array<long>, group long"
    index = stored(rows.mapInPandas(hashed, schema), "index")
    # a query visits a group by chance, or because its entries lie where queries do
    share = F.greatest(F.lit(tables * probes / groups), F.col("entries") * (1.0 / shape.n))
    blocks = F.ceil(F.least(F.lit(1.0), share) * (shape.queries / query_rows))
    sizes = index.groupBy("group").agg(F.sum(F.size("buckets")).alias("entries"))
    sizes = sizes.select(
        "group",
        F.ceil(F.col("entries") / (2 * group_rows)).cast("int").alias("parts"),
        F.greatest(F.lit(1), blocks.cast("int")).alias("blocks"),
    )
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.col("parts")).cast("int")
    block = F.pmod(F.xxhash64(F.lit("block"), "id"), F.col("blocks")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.where("q").mapInPandas(probing, schema).join(sizes, "group")
    asked = asked.select("id", "v", "buckets", "group", block.alias("block"), every("parts").alias("part"))
    index = index.join(sizes, "group").select("id", "v", "buckets", "group", part.alias("part"), every("blocks").alias("block"))

    def closest(ids: np.ndarray, x: np.ndarray, v: np.ndarray, found: np.ndarray, rough: np.ndarray) -> tuple:
        """Ids and scores of the best ``k`` rows ``found``; ``rough`` are their scores in single precision."""
        if len(found) > k:
            # single precision leaves out what cannot be among the best; the rest is exact
            found = found[rough >= np.partition(rough, -k)[-k] - 1e-4]
        with np.errstate(over="ignore", invalid="ignore"):
            score = x[found] @ v
        best = np.lexsort((ids[found], -score))[:k]
        return ids[found[best]], score[best]

    def frame(queries: list, best: list) -> pd.DataFrame:
        if not best:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        near, score = (np.concatenate(part) for part in zip(*best))
        return pd.DataFrame({"query_id": np.repeat(queries, [len(i) for i, _ in best]), "vec_id": near, "score": score})

    def over_largest(x: np.ndarray) -> np.ndarray:
        direction, length = unit(x)
        return (direction * np.exp(length - length.max())[:, None]).astype(np.float32)

    def rank(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(queries):
            return frame([], [])
        x, ids = np.vstack(entries["v"].to_numpy()), entries["id"].to_numpy()
        near = over_largest(x)
        per = entries["buckets"].map(len).to_numpy()
        bucket, owner = np.concatenate(entries["buckets"].to_numpy()), np.repeat(np.arange(len(x)), per)
        order = np.argsort(bucket, kind="stable")
        owner = owner[order]
        bucket, start, count = np.unique(bucket[order], return_index=True, return_counts=True)
        asked, best = [], []
        for at in range(0, len(queries), 64):
            part = queries.iloc[at : at + 64]
            v = np.vstack(part["v"].to_numpy())
            direction = unit(v)[0].astype(np.float32)
            reached = []
            for q, visits in zip(part["id"], part["buckets"]):
                place = np.minimum(np.searchsorted(bucket, visits), len(bucket) - 1)
                place = place[bucket[place] == visits]
                a, size = start[place], count[place]
                seen = np.zeros(len(x), dtype=bool)
                seen[owner[np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())]] = True
                found = np.flatnonzero(seen)
                reached.append(found[ids[found] != q])
            # where most rows are candidates, one product for all queries is cheaper than gathering rows
            dense = sum(map(len, reached)) * 4 > len(x) * len(part)
            scores = direction @ near.T if dense else None
            for i, (q, found) in enumerate(zip(part["id"], reached)):
                rough = scores[i, found] if dense else near[found] @ direction[i]
                asked.append(q)
                best.append(closest(ids, x, v[i], found, rough))
        return frame(asked, best)

    def scan(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(queries):
            return frame([], [])
        x, ids = np.vstack(entries["v"].to_numpy()), entries["id"].to_numpy()
        near, best = over_largest(x), []
        for q, v in zip(queries["id"], queries["v"]):
            found = np.flatnonzero(ids != q)
            best.append(closest(ids, x, v, found, near[found] @ unit(v[None])[0][0].astype(np.float32)))
        return frame(queries["id"].tolist(), best)

    pairs = "query_id long, vec_id long, score double"
    keys = ["group", "part", "block"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(rank, pairs)
    found = stored(_best(found, k), "found")

    # the rest, exactly: all vectors in blocks against blocks of the queries that found too few
    reached = found.groupBy("query_id").count().where(F.col("count") >= k)
    starved = stored(rows.where("q").join(reached, F.col("id") == F.col("query_id"), "left_anti").select("id", "v"), "starved")
    short = starved.count()
    if not short:
        return found
    spread = lambda of, n: F.pmod(F.xxhash64(F.lit(of), "id"), F.lit(n)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    parts, blocks = -(-shape.n // group_rows), -(-short // query_rows)
    entries = rows.select("id", "v", spread("part", parts).alias("part"), across(blocks).alias("block"))
    starved = starved.select("id", "v", spread("block", blocks).alias("block"), across(parts).alias("part"))
    exact = entries.groupBy("part", "block").cogroup(starved.groupBy("part", "block")).applyInPandas(scan, pairs)
    rest = found.join(reached, "query_id", "left_semi")
    return rest.unionByName(_best(exact, k))


def _best(found: DataFrame, k: int) -> DataFrame:
    """Ranks 1 to ``k`` of each query; at most ``k`` rows of a query come from each task that it visits."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
