"""Join of texts by Jaccard similarity of word shingles, with Bayesian candidate pruning.

1. Texts with the same words in the same order are one class; everything below is done once per
   class. Each class gets MinHash values of its shingles, computed in tasks.
2. Classes that agree in all values of a band are candidates. Buckets with the same members are
   looked at once. A bucket is cut into blocks; two blocks meet in one task, which compares the
   MinHash values of their pairs a few at a time and drops a pair when the posterior probability
   that its similarity reaches the threshold falls below a tolerance. A task gives a spanning
   forest of the surviving pairs, never the pairs, and components of these edges are families.
3. Within a family, blocks meet again with their whole shingle sets; surviving pairs are verified
   exactly. A task gives the number of links of each class and a spanning forest of the links.

Links between pairs at or above the threshold are found with the probability of sharing a band,
``1 - (1 - t**ROWS)**BANDS`` (more than 0.99995 at t = 0.8, more above), times that of not being
pruned (at least 1 - 8 * TOLERANCE). There is no cap on candidates, partners or class sizes.

Defined results: a text of fewer words than a shingle is one shingle; texts without any word are
linked to equal texts only; a null text is linked to nothing; repeated rows are copies; a component
is named by its smallest id (null if none of its rows has one).
"""

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_side, stored, words_of
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
HASHES = 128
#: hashes compared before pairs are pruned again
STEP = 16
#: a pair is dropped when P(similarity >= threshold | matches so far) is below this
TOLERANCE = 1e-6
BLOCK = 256
#: up to so many documents to drop (16 bytes each) are broadcast; beyond, a shuffle join
BROADCAST_ROWS = 500_000
_SEED = 20_011
_VOCABULARY = 400_000


def _constants() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(_SEED)
    odd = draw.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
    return odd, draw.integers(0, 2**32, HASHES, dtype=np.uint32)


class Shingler:
    """64-bit hashes of shingles; word hashes are kept for words seen lately."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known: dict[str, int] = {}
        self.odd, self.mix = _constants()

    def words(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _VOCABULARY:
            known.clear()
        for w in {w for w in words if w not in known}:
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))

    def shingles(self, words: list[str]) -> np.ndarray:
        """Sorted distinct hashes of the shingles; one for fewer words than a shingle, none for none."""
        h = self.words(words)
        size = min(self.size, len(h))
        if not size:
            return h
        out = np.zeros(len(h) - size + 1, dtype=np.uint64)
        for k in range(size):
            out ^= h[k : k + len(out)]
            out *= np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """MinHash values; texts of any length are taken in slices."""
        low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        best = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(low), 256):
            h = (low[at : at + 256, None] ^ self.mix) * self.odd
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            np.minimum(best, h.min(axis=0), out=best)
        return best


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared hashes, the fewest matches with which a pair goes on.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def surviving(a: np.ndarray, b: np.ndarray, same: bool, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of two signature blocks that are never pruned (same: each pair once)."""
    i, j = np.triu_indices(len(a), 1) if same else (x.ravel() for x in np.indices((len(a), len(b))))
    met = np.zeros(len(i), dtype=np.int16)
    for n, enough in least.items():
        met = met + (a[i, n - STEP : n] == b[j, n - STEP : n]).sum(axis=1, dtype=np.int16)
        go = met >= enough
        i, j, met = i[go], j[go], met[go]
    return i, j


def forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Numbers of edges that join all that the edges join, without circles."""
    root: dict[int, int] = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = top(x), top(y)
        if x != y:
            root[x] = y
            out.append(k)
    return out


_SIGNED = "doc_id long, text_hash long, key long, text_key binary, words int, signature binary, bands array<long>"


def signed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """A row for each document: its class key (64 bits of a 128-bit hash), signature and bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            rows = []
            for number, hashed, text_ in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                number = None if pd.isna(number) else int(number)
                words = words_of(text_)
                if words:
                    own = hashlib.md5(" ".join(words).encode()).digest()
                    s = shingler.signature(shingler.shingles(words))
                    parts = s[: BANDS * ROWS].reshape(BANDS, ROWS)
                    bands = [xxhash.xxh3_64_intdigest(p.tobytes(), seed=k) - 2**63 for k, p in enumerate(parts)]
                    sign = (s & np.uint32(0xFFFF)).astype(np.uint16).tobytes()
                else:
                    bands, sign = [], None
                    own = None if text_ is None else hashlib.md5(b"\0" + text_.encode()).digest()
                key = None if own is None else int.from_bytes(own[:8], "little", signed=True)
                rows.append((number, hashed, key, own, len(words), sign, bands))
            names = ["doc_id", "text_hash", "key", "text_key", "words", "signature", "bands"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "key": "Int64"})

    own = docs.select(
        F.col(doc).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )
    return own.mapInPandas(run, _SIGNED)


def _blocked(members: DataFrame, group: str, key: str, block: int) -> DataFrame:
    """Members of a group dealt into blocks of about ``block``; a copy for each pair of blocks.

    Adds ``x`` and ``y``, the numbers of the two blocks that meet (x <= y), and ``own``. Only
    groups of more than a block are looked up, so that no group has to meet for it.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("members")).where(F.col("members") > block)
    large = small_side(stored(sizes, "large"), BROADCAST_ROWS)
    many = members.join(large, group, "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("members") / block), F.lit(1)).cast("int")
    )
    own = many.withColumn("own", F.pmod(F.xxhash64(F.lit("block"), key), F.col("blocks")).cast("int"))
    meets = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (
        meets.withColumn("x", F.least("own", "other"))
        .withColumn("y", F.greatest("own", "other"))
        .drop("members", "blocks", "other")
    )


def _sides(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    rows = rows.sort_values("key").reset_index(drop=True)
    x, y = rows["x"].iloc[0], rows["y"].iloc[0]
    return rows[rows["own"] == x].reset_index(drop=True), rows[rows["own"] == y].reset_index(drop=True), x == y


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(len(column), HASHES)


def families(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, component): classes that may be linked, directly or through others."""
    least = least_matches()
    banded = classes.select("key", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(2), "key")).alias("h2"),
    )
    once = buckets.where("n > 1").groupBy("n", "h1", "h2").agg(F.min("bucket").alias("bucket")).select("bucket")
    members = stored(banded.join(once, "bucket"), "members").join(classes.select("key", "signature"), "key")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, same = _sides(rows)
        i, j = surviving(_signatures(a["signature"]), _signatures(b["signature"]), same, least)
        ka, kb = a["key"].to_numpy()[i], b["key"].to_numpy()[j]
        keep = forest(ka, kb)
        return pd.DataFrame({"u": ka[keep], "v": kb[keep]})

    edges = _blocked(members, "bucket", "key", block).groupBy("bucket", "x", "y").applyInPandas(compare, "u long, v long")
    return components(edges, "families")


def verified(docs: DataFrame, classes: DataFrame, member: DataFrame, doc: str, text: str, block: int = BLOCK) -> DataFrame:
    """(key, links, other) of exactly verified links, in parts.

    Rows with ``links`` count the rows linked to a class in one meeting of blocks; rows with
    ``other`` are edges that join what the links join.
    """
    least = least_matches()
    # the one row whose text stands for the class; null ids and the largest one are told apart by text
    order = F.coalesce("any.doc_id", F.lit(2**63 - 1)).alias("d")
    first = classes.select("key", "signature", "copies", order, F.col("any.text_hash").alias("h"), "text_key").join(
        member.select(F.col("node").alias("key"), F.col("component").alias("family")), "key"
    )
    shared = stored(first, "first")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            done = [shingler.shingles(words_of(t)).tobytes() for t in batch["text"]]
            yield batch.drop(columns="text").assign(shingles=done)

    own = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc).cast("long"), F.lit(2**63 - 1)).alias("d"),
        F.xxhash64(F.col(text)).alias("h"),
        F.col(text).alias("text"),
    )
    # ids can be shared by many rows: a text is looked up by both, and once if rows are repeated
    wanted = small_side(shared.select("d", "h"), BROADCAST_ROWS)
    texts = own.join(wanted, ["d", "h"], "left_semi").dropDuplicates(["d", "h"])
    texts = texts.join(shared, ["d", "h"]).select("key", "family", "copies", "signature", "text_key", "text")
    read = texts.mapInPandas(
        _only_own(sets), "key long, family long, copies long, signature binary, shingles binary"
    ).dropDuplicates(["key"])
    read = stored(read, "sets")

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, same = _sides(rows)
        i, j = surviving(_signatures(a["signature"]), _signatures(b["signature"]), same, least)
        left = [np.frombuffer(s, dtype=np.uint64) for s in a["shingles"]]
        right = left if same else [np.frombuffer(s, dtype=np.uint64) for s in b["shingles"]]
        linked = np.zeros(len(i), dtype=bool)
        order = np.argsort(i, kind="stable")
        for run in np.split(order, np.flatnonzero(np.diff(i[order])) + 1) if len(i) else []:
            mine, at = left[i[run[0]]], 0
            for k in run:
                other = right[j[k]]
                both = np.searchsorted(mine, other)
                hit = int((mine[np.minimum(both, len(mine) - 1)] == other).sum())
                linked[k] = hit >= THRESHOLD * (len(mine) + len(other) - hit) - 1e-9
        i, j = i[linked], j[linked]
        ka, kb = a["key"].to_numpy(), b["key"].to_numpy()
        na, nb = a["copies"].to_numpy(), b["copies"].to_numpy()
        counts = pd.concat(
            [pd.DataFrame({"key": ka[i], "links": nb[j]}), pd.DataFrame({"key": kb[j], "links": na[i]})]
        ).groupby("key", as_index=False)["links"].sum()
        keep = forest(ka[i], kb[j])
        edges = pd.DataFrame({"key": ka[i][keep], "other": kb[j][keep]})
        # nullable integers from the start: keys take all 64 bits, which a float cannot hold
        counts, edges = counts.astype("Int64").assign(other=pd.NA), edges.astype("Int64").assign(links=pd.NA)
        return pd.concat([counts, edges])[["key", "links", "other"]].astype("Int64")

    return _blocked(read, "family", "key", block).groupBy("family", "x", "y").applyInPandas(
        verify, "key long, links long, other long"
    )


def _only_own(sets):
    """``sets`` over the rows whose text has the key of the class, without that key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def own(batch):
            key = [hashlib.md5(" ".join(words_of(t)).encode()).digest() for t in batch["text"]]
            return batch[[a == bytes(b) for a, b in zip(key, batch["text_key"])]].drop(columns="text_key")

        return sets(own(b) for b in batches)

    return run


def similarity_classes(docs: DataFrame, doc: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, component, class_id, links.

    ``class_id`` is the smallest id among the rows that are linked directly or through others;
    ``links`` is the number of other rows with a similarity of at least the threshold, copies
    included. Rows without a text have no component and no links.
    """
    rows = stored(signed(docs, doc, text), "signed")
    classes = stored(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("any"),
            F.max("signature").alias("signature"),
            F.max("bands").alias("bands"),
            F.max("text_key").alias("text_key"),
        ),
        "classes",
    )
    signed_classes = classes.where("signature is not null")
    member = stored(families(signed_classes, block), "family")
    found = stored(verified(docs, signed_classes, member, doc, text, block), "verified")
    joined = components(found.where("other is not null").select(F.col("key").alias("u"), F.col("other").alias("v")), "linked")
    counts = found.where("links is not null").groupBy("key").agg(F.sum("links").alias("links"))
    of = (
        classes.select("key", "copies", F.col("any.doc_id").alias("any_doc"))
        .join(joined.select(F.col("node").alias("key"), "component"), "key", "left")
        .join(counts, "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    names = of.groupBy("component").agg(F.min("any_doc").alias("class_id"))
    of = of.join(names, "component").select(
        "key", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    kept = rows.select("doc_id", "text_hash", "key").join(of, "key", "left")
    return kept.select(
        "doc_id",
        "text_hash",
        "component",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that with its smallest id (ties: smallest text hash).

    Rows without a text are kept; of a class without any id one row is kept.
    """
    of = stored(similarity_classes(docs, doc, text).where("component is not null"), "classes")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("o"), F.col("text_hash").alias("h"))
    first = of.groupBy("component").agg(F.min(order).alias("first")).select("component", "first")
    later = of.join(first, "component").where(order != F.col("first"))
    later = small_side(
        stored(later.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h")).distinct(), "later"), BROADCAST_ROWS
    )
    own = fresh(docs, "own_text_hash")
    hashed = docs.withColumn(own, F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text))))
    same = hashed[doc].cast("long").eqNullSafe(F.col("__d")) & (F.col(own) == F.col("__h"))
    kept = hashed.join(later, same, "left_anti")
    again = of.groupBy("doc_id", "text_hash").count().where(F.col("count") > 1)
    again = stored(again.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h")), "again")
    if again.isEmpty():
        return kept.drop(own)
    # only rows that agree in id and text need a shuffle to leave one of them
    again = small_side(again, BROADCAST_ROWS)
    repeated = kept.join(again, same, "left_semi").dropDuplicates([doc, own])
    return kept.join(again, same, "left_anti").unionByName(repeated).drop(own)
