"""Runs of repeated words: stretches that one phrase fills several times over.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal),
at least ``min_length`` words and ``min_exponent * q`` words long, that no neighbouring word extends.

Method: maximal pairs of a suffix array. Two places ``i < j`` whose texts agree for exactly ``l``
words, and whose left neighbours differ, are a maximal pair; if ``l`` is long against their
distance ``d = j - i``, the words ``i .. j + l`` repeat with period ``d`` and cannot be extended on
either side, so the pair already is a run. The LCP-interval tree is walked bottom-up. An interval
keeps its places in order, each in the class of its left word; when two intervals meet, the places
of the smaller one are looked up between those of the larger. Of all pairs of different classes
only neighbours in that order matter: a place between the two would repeat at a shorter distance,
and the run is then found with its smallest period. Hence a text of n words costs O(n log n) steps,
whatever it repeats.

Documents in which no ``l`` words stand twice (``l`` the least that a run needs) have no run;
hashed windows find them a batch at a time, and equal hashes only mean that the tree is built.

Defined results: a null, empty or blank text has no words, no run and an empty collapsed text;
repeated rows are judged each; a null id is returned as it is; an empty table gives no row; texts
of any length are read whole, a document's arrays (some 100 bytes a word) being one task's.
"""

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: characters that a task works on at once; a longer document is a batch of its own
BATCH_CHARS = 4_000_000
_CHUNK = 2_000


class _Places:
    """Ordered places of an interval, in chunks, so that adding one moves few others."""

    __slots__ = ("chunks", "tops", "size")

    def __init__(self, place: int):
        self.chunks, self.tops, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        return (p for chunk in self.chunks for p in chunk)

    def around(self, place: int) -> tuple[int, int]:
        """The places before and behind, or -1."""
        k = bisect_left(self.tops, place)
        if k == len(self.tops):
            return self.tops[-1], -1
        chunk = self.chunks[k]
        at = bisect_left(chunk, place)
        return chunk[at - 1] if at else self.tops[k - 1] if k else -1, chunk[at]

    def add(self, place: int) -> None:
        k = min(bisect_left(self.tops, place), len(self.tops) - 1)
        chunk = self.chunks[k]
        insort(chunk, place)
        if len(chunk) > 2 * _CHUNK:
            self.chunks[k : k + 1] = chunk[:_CHUNK], chunk[_CHUNK:]
            self.tops[k : k + 1] = chunk[_CHUNK - 1], chunk[-1]
        else:
            self.tops[k] = chunk[-1]
        self.size += 1


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of word numbers, and the words that neighbours in it have in common."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    ranks, step = [rank], 1
    while rank.max(initial=-1) < n - 1:
        behind = np.zeros(n, dtype=np.int64)
        behind[: max(n - step, 0)] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + behind, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank)
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[ranks[k][a[inside]] == ranks[k][b[inside]]]
        for x in (a, b, common):
            x[same] += 1 << k
    return order, common


def least_common(min_length: int, min_exponent: int) -> int:
    """The fewest words that a run's maximal pair has in common."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length // min_exponent + 2))


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of word numbers, by start, then period."""
    least = least_common(min_length, min_exponent)
    order, common = suffixes(words)
    left = [-1, *words[:-1].tolist()]
    periods: dict[tuple[int, int], int] = {}

    def meet(one: _Places, other: _Places, length: int) -> _Places:
        small, large = (one, other) if one.size < other.size else (other, one)
        pairs = [(p, large.around(p)) for p in small]
        for p, (before, behind) in pairs:
            for i, j in ((before, p), (p, behind)):
                if i >= 0 and j >= 0 and left[i] != left[j]:
                    d = j - i
                    if length + d >= max(min_length, min_exponent * d):
                        run = (i, j + length)
                        periods[run] = min(periods.get(run, d), d)
            large.add(p)
        return large

    deep = np.flatnonzero(common >= least)
    for part in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1) if len(deep) else []:
        depths = [*common[part].tolist(), 0]
        stack: list[tuple[int, _Places]] = []
        for place, depth in zip(order[part[0] : part[-1] + 2].tolist(), depths):
            places = _Places(place)
            while stack and stack[-1][0] > depth:
                length, before = stack.pop()
                places = meet(before, places, length)
            if stack and stack[-1][0] == depth:
                stack[-1] = (depth, meet(stack[-1][1], places, depth))
            else:
                stack.append((depth, places))
    return sorted((start, end - start, d) for (start, end), d in periods.items())


def _recurring(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which documents have ``width`` words twice (by a hash, so maybe a few more)."""
    docs = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    found = np.zeros(len(starts) - 1, dtype=bool)
    if len(words) < width:
        return found
    at = np.flatnonzero(docs[: len(words) - width + 1] == docs[width - 1 :])
    with np.errstate(over="ignore"):
        key = docs[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(width):
            key = (key ^ words[at + k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
    by = np.argsort(key)
    twice = by[1:][key[by[1:]] == key[by[:-1]]]
    found[docs[at[twice]]] = True
    return found


def _batch(ids: pa.Array, texts: pa.Array, min_length: int, min_exponent: int) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.string()))
    flat = split.flatten()
    filled = pc.greater(pc.binary_length(flat), 0)
    upto = np.concatenate([[0], np.cumsum(np.asarray(filled, dtype=np.int64))])
    offsets = split.offsets.to_numpy()
    starts = upto[offsets - offsets[0]]
    flat = flat.filter(filled)
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    kept = np.ones(len(words), dtype=bool)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ids))]
    for d in np.flatnonzero(_recurring(words, starts, least_common(min_length, min_exponent))):
        a, b = int(starts[d]), int(starts[d + 1])
        runs[d] = find_runs(words[a:b], min_length, min_exponent)
        for start, length, period in runs[d]:
            kept[a + start + period : a + start + length] = False
    left = np.concatenate([[0], np.cumsum(kept)])[starts]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept))), " ")
    kind = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
    spans = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(starts), pa.int64()), spans, collapsed],
        names=["id", "words", "runs", "collapsed"],
    )


def repeated_runs(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """Per row: id, number of words, runs (start, length, period; in words), and the collapsed text.

    The collapsed text has the words that no run covers after its first period, joined by one space.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            chars = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(ids):
                before = chars[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(chars, before + BATCH_CHARS, side="right")))
                yield _batch(ids.slice(at, end - at), texts.slice(at, end - at), min_length, min_exponent)
                at = end

    given = docs.select(F.col(doc).alias("id"), F.col(text).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    spans = "array<struct<start:bigint,length:bigint,period:bigint>>"
    found = given.mapInArrow(work, f"id {kind}, words bigint, runs {spans}, collapsed string")
    return found.withColumnRenamed("id", doc)
