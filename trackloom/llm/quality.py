"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text is
cut into blocks; each block is compressed with either dictionary, and the difference of the two
sizes, divided by their sum, says which dictionary explains the text better. Text that repeats
itself is small under both, so the logarithm of the compressed share of the text is measured
beside it. A logistic curve, fitted on labelled texts that were kept out of the dictionaries,
turns the two into a probability. Evidence grows with length: a text of n bytes has n / (n + 256) of it, the
rest is the share of good labels, which null and empty texts get as it is unless labelled ones say otherwise.

Defined results: repeated rows and equal texts score alike; an empty table gives no rows; long texts are
measured whole; without labels every score is 0.5.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled documents sampled per class, chosen by a hash of their id
SAMPLE_ROWS = 2_000
DICTIONARY_BYTES = 65_536
BLOCK_BYTES = 2_048
LEVEL = 3
#: a text of so many bytes counts half of what a long one does
HALF_BYTES = 256


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and calibration; its size is bounded by twice ``DICTIONARY_BYTES``.

    Without dictionaries (a class had no usable sample) every text gets ``sigmoid(intercept)``.
    """

    good: bytes | None
    bad: bytes | None
    slopes: tuple[float, float, float] = (0.0, 0.0, 0.0)
    intercept: float = 0.0
    block_bytes: int = BLOCK_BYTES
    level: int = LEVEL


def _dictionary(texts: list[bytes], size: int, block: int) -> bytes | None:
    samples = [t[i : i + block] for t in texts for i in range(0, len(t), block)]
    samples = [s for s in samples if len(s) >= 8]
    if not samples:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too few samples to train: their text itself is the dictionary
        return b"".join(samples)[-size:]


class _Sizes:
    """Sizes of whole texts, block by block, under either dictionary."""

    def __init__(self, model: QualityModel):
        self.block = model.block_bytes
        self.coders = None
        if model.good and model.bad:
            self.coders = []
            for raw in (model.good, model.bad):
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=model.level)
                self.coders.append(
                    zstandard.ZstdCompressor(
                        dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False
                    )
                )

    def measure(self, text: str | None) -> tuple[float, float]:
        """(bad - good) / (bad + good), positive if more like good text; log of (good / length).

        Null and empty texts give zeros.
        """
        if not text or self.coders is None:
            return 0.0, 0.0
        data = text.encode("utf-8", "replace")
        good, bad = (
            sum(len(c.compress(data[i : i + self.block])) for i in range(0, len(data), self.block))
            for c in self.coders
        )
        return (bad - good) / (bad + good), min(0.0, math.log(good / len(data)))

    def features(self, text: str | None) -> tuple[float, float, float]:
        """The two measures and 1, each times the weight of the text's length."""
        size = len(text.encode("utf-8", "replace")) if text and self.coders else 0
        weight = size / (size + HALF_BYTES)
        difference, share = self.measure(text)
        return weight * difference, weight * share, weight


def _logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray, prior: float) -> tuple[tuple[float, ...], float]:
    """Slopes and intercept by Newton steps; weights ``rows`` of the rows.

    Slopes are pulled weakly towards 0, the intercept by one row's worth towards ``prior``.
    """
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    w, ridge = np.zeros(a.shape[1]), np.array([1e-3] * x.shape[1] + [1.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w + prior, -30, 30)))
        curve = (a * (rows * p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, a.T @ (rows * (y - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w[:-1] / scale), float(w[-1] + prior)


def agreed(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of ids whose labels agree; null labels and null ids are left out."""
    return (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", "quality")
    )


def good_share(labels: DataFrame) -> float | None:
    """Share of good ones among all agreed labels; None without any."""
    return agreed(labels).agg(F.avg("quality")).first()[0]


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple]:
    """(whole text, quality, part) of at most ``rows`` documents per class, part 0 or 1.

    Ids are chosen by a hash, so the sample does not depend on partitioning. Ids with labels of
    both classes, and null labels, are left out. Only the chosen ids (at most ``2 * rows``) are
    broadcast to the documents.
    """
    ids = agreed(labels).withColumn("h", F.xxhash64(F.lit("quality"), "doc_id"))
    chosen = None
    for q in (0, 1):
        part = ids.where(F.col("quality") == q).orderBy("h", "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .orderBy("h", "doc_id", "text")
        .limit(4 * rows)
    )
    return [(r.text, r.quality, r.h & 1) for r in found.collect()]


def fit(rows: list[tuple], dictionary_bytes: int = DICTIONARY_BYTES, share: float | None = None) -> QualityModel:
    """Part 0 makes the dictionaries, part 1 the calibration. No rows: every score is 0.5.

    ``share`` is the share of good labels in the corpus (default: in the rows); rows of either class are
    weighted to it, as the sample holds as many of both.
    """
    texts = {(q, p): [t.encode() for t, q2, p2 in rows if (q2, p2) == (q, p)] for q in (0, 1) for p in (0, 1)}
    good = _dictionary(texts[1, 0], dictionary_bytes, BLOCK_BYTES)
    bad = _dictionary(texts[0, 0], dictionary_bytes, BLOCK_BYTES)
    sizes = _Sizes(QualityModel(good, bad))
    held = [(sizes.features(t), q) for t, q, p in rows if p == 1]
    if not held:
        return QualityModel(good, bad)
    x, y = (np.array(v, dtype=float) for v in zip(*held))
    if len(set(y)) == 1:
        return QualityModel(None, None, intercept=3.0 if y[0] else -3.0)
    share = y.mean() if share is None else min(max(share, 0.01), 0.99)
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return QualityModel(good, bad, *_logistic(x, y, weights, math.log(share / (1 - share))))


def score(text: Column, model: QualityModel) -> Column:
    """Probability of a good label for the whole text; null and empty texts get the intercept's, near the share."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = _Sizes(model)
        for texts in batches:
            x = np.array([sizes.features(t) for t in texts], dtype=float).reshape(len(texts), 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(model.slopes) + model.intercept, -30, 30))))

    return scored(text)
