"""Conflict-constrained best-fit packing of documents into sequences of a fixed length.

A document is cut into pieces of at most the capacity. Pieces are dealt into groups of bounded
size by a hash and packed group by group: longest first, each into the fullest bin that has room
and no conflict. Open bins are kept in the order of their room and carry a bitmap of the sources
and one of the duplicate clusters they hold; from the first bin with enough room the search goes
on until it finds a compatible one, and opens a new bin if there is none.

Two pieces of one source, or of one duplicate cluster, never share a bin. Defined results: null
and empty texts are pieces of one unit (their end mark); a null source or cluster conflicts with
nothing; ties in length go to the smaller id, then to the order of values; every row is packed.
"""

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

CAPACITY = 2_048
#: expected pieces in a group; a task holds a few numbers for each
GROUP_ROWS = 4_096
_PACKED = "doc_id long, text_hash long, piece int, start long, size int, bin long, position int, at int"


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null and empty texts."""
    return F.coalesce(F.size(F.array_remove(F.split(F.trim(text), r"\s+"), "")), F.lit(0))


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int]]:
    """(bin, position, at) of each piece; pieces are given longest first."""
    bit_of: dict = {}

    def bit(kind: str, value) -> int:
        if value is None:
            return 0
        return 1 << bit_of.setdefault((kind, value), sum(1 for k, _ in bit_of if k == kind))

    several = pd.Series(clusters, dtype=object).duplicated(keep=False).tolist()
    open_bins: list[tuple[int, int]] = []  # (room, bin), tightest first
    held: list[list[int]] = []  # bitmaps of sources and of clusters, pieces
    out = []
    for size, source, cluster, repeated in zip(sizes, sources, clusters, several):
        source, cluster = bit("source", source), bit("cluster", cluster) if repeated else 0
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            marks = held[open_bins[at][1]]
            if not (marks[0] & source or marks[1] & cluster):
                break
            at += 1
        if at < len(open_bins):
            room, number = open_bins.pop(at)
        else:
            room, number = capacity, len(held)
            held.append([0, 0, 0])
        marks = held[number]
        out.append((number, marks[2], capacity - room))
        marks[0] |= source
        marks[1] |= cluster
        marks[2] += 1
        if room > size:
            insort(open_bins, (room - size, number))
    return out


def pieces(docs: DataFrame, doc: str, text: str, source: str, size: Column, cluster: Column, capacity: int) -> DataFrame:
    """(doc_id, text_hash, source, cluster, piece, start, size) of all rows; no text is carried."""
    items = docs.select(
        F.col(doc).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(source).cast("string").alias("source"),
        cluster.cast("long").alias("cluster"),
        (size.cast("long") + 1).alias("total"),
    )
    last = ((F.col("total") - 1) / capacity).cast("int")
    cut = items.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece").cast("long") * capacity
    return cut.withColumn("start", start).withColumn(
        "size", F.least(F.lit(capacity).cast("long"), F.col("total") - start).cast("int")
    ).drop("total")


def pack(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: its document, place in the document, bin, and place in the bin.

    ``size`` is the length of a document without its end mark (default: words), ``cluster`` its
    duplicate cluster (default: equal texts but for case). The last piece ends with the end mark.
    """
    size = word_count(F.col(text)) if size is None else size
    cluster = F.when(F.col(text).isNotNull(), F.xxhash64(F.lower(F.col(text)))) if cluster is None else cluster
    items = pieces(docs, doc, text, source, size, cluster, capacity)
    # pieces that agree in all values would meet in one group: they are spread by their position too
    items = stored(items.withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-items.count() // group_rows))
    same = ["doc_id", "text_hash", "piece"]
    crowd = items.groupBy(*same).count().where(F.col("count") > max(1, group_rows // 8))
    crowd = crowd.select(*[F.col(c).alias(f"c_{c}") for c in same], F.lit(True).alias("crowd"))
    crowd = F.broadcast(crowd) if crowd.count() <= 100_000 else crowd
    match = [items[c].eqNullSafe(F.col(f"c_{c}")) for c in same]
    dealt = items.join(crowd, match, "left").withColumn(
        "group",
        F.pmod(F.xxhash64(*same, F.when(F.col("crowd"), F.col("row"))), F.lit(groups)),
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "text_hash", "piece"], ascending=[False, True, True, True])
        value = lambda c: [None if pd.isna(v) else v for v in rows[c]]
        placed = best_fit(rows["size"].tolist(), value("source"), value("cluster"), capacity)
        rows["bin"], rows["position"], rows["at"] = zip(*placed)
        rows["bin"] += int(rows["group"].iloc[0]) << 32
        return rows[["doc_id", "text_hash", "piece", "start", "size", "bin", "position", "at"]]

    return dealt.select(*items.columns, "group").drop("row").groupBy("group").applyInPandas(run, _PACKED)


def sequences(packed: DataFrame, docs: DataFrame, doc: str = "doc_id", text: str = "text", end: str = "<|end|>") -> DataFrame:
    """(bin, text): the words of a bin's pieces in their order, an end mark after each document."""
    own = docs.select(
        F.col(doc).cast("long").alias("d"),
        F.xxhash64(F.col(text)).alias("h"),
        F.concat(F.coalesce(F.array_remove(F.split(F.trim(F.col(text)), r"\s+"), ""), F.array().cast("array<string>")), F.array(F.lit(end))).alias("words"),
    ).dropDuplicates(["d", "h"])
    part = packed.join(own, packed["doc_id"].eqNullSafe(own["d"]) & (packed["text_hash"] == own["h"])).select(
        "bin", F.struct("position", F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.col("size")), " ").alias("text")).alias("p")
    )
    return part.groupBy("bin").agg(F.array_join(F.sort_array(F.collect_list("p"))["text"], " ").alias("text"))
