"""Language identification by a linear-chain conditional random field over words.

Words are runs of letters; a sequence is a line, in parts of at most ``SEQUENCE`` words. The
features of a word are its letter pairs and triples with marks for its ends (so affixes of one and
two letters), affixes of three letters, and the language in whose lexicon it is. They and the
transitions between languages are learned together; forward-backward gives the probability of each
language for each word, and a text is given the language with the largest mean.

Learned from at most ``SAMPLE_ROWS`` documents of each language, chosen by a hash of the id, with a
span of ``SAMPLE_CHARS`` characters from a place that the same hash gives. Whole texts are labelled.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold

SAMPLE_ROWS = 200
SAMPLE_CHARS = 2_000
SEQUENCE = 256
TABLE_BITS = 16
LEXICON_WORDS = 20_000
ROUNDS = 25
#: words labelled at once, and words whose scores a task keeps
CHUNK = 200_000
KEPT = 400_000
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Languages, weights of hashed features (2**TABLE_BITS rows), transitions and lexicon."""

    languages: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, int]


def lines_of(text: str | None) -> list[list[str]]:
    """Words of the sequences of a text."""
    out = []
    for line in (text or "").lower().split("\n"):
        words = _LETTERS.findall(line)
        out += [words[i : i + SEQUENCE] for i in range(0, len(words), SEQUENCE)]
    return out


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for all features of all words, and the word of each feature."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # letters from here to the word's end
    rows, owners = [], []

    def add(n: int, where: np.ndarray) -> None:
        at = np.flatnonzero(where & (left >= n))
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ codes[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        rows.append((h >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
        owners.append(word[at])

    every = np.ones(len(codes), dtype=bool)
    add(2, every)
    add(3, every)
    add(4, (codes == 2) | (left == 4))
    known = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    if known:
        # the last rows of the table belong to the lexicons, one for each language
        rows.append((1 << TABLE_BITS) - 1 - np.array([k for _, k in known]))
        owners.append(np.array([i for i, _ in known]))
    return np.concatenate(rows), np.concatenate(owners)


def _emissions(words: list[str], weights: np.ndarray, lexicon: dict[str, int]) -> np.ndarray:
    rows, owners = features(words, lexicon)
    return np.column_stack([np.bincount(owners, w[rows], len(words)) for w in weights.T])


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Probability of each label for each word of sequences laid end to end.

    With ``pairs`` also the expected number of each transition.
    """
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    start = (np.cumsum(lengths) - lengths)[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    alpha, gamma = np.empty_like(e), np.empty_like(e)
    for t, n in enumerate(active):
        at = start[:n] + t
        a = e[at] if t == 0 else (a[:n] @ step) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    beta = np.ones((len(size), e.shape[1]))
    expected = np.zeros_like(step)
    for t in range(len(active) - 1, -1, -1):
        n, after = active[t], active[t + 1] if t + 1 < len(active) else 0
        if after:
            ahead = e[start[:after] + t + 1] * beta[:after]
            if pairs:
                now = alpha[start[:after] + t]
                total = np.einsum("ni,ij,nj->n", now, step, ahead)
                expected += step * ((now / total[:, None]).T @ ahead)
            b = ahead @ step.T
            beta[:after] = b / b.sum(axis=1, keepdims=True)
        at = start[:n] + t
        g = alpha[at] * beta[:n]
        gamma[at] = g / g.sum(axis=1, keepdims=True)
    return (gamma, expected) if pairs else gamma


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(text span, lang) of at most ``rows`` documents of each language, outside fold 2.

    A language's rows are thinned by their hash before they are ranked, so no large group meets.
    """
    labelled = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2) & (F.length("text") > 0))
    ids = labelled.select("lang", "doc_id", F.xxhash64(F.lit("lang"), "doc_id").alias("h"))
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    thin = ids.join(counts, "lang").where(F.pmod("h", F.lit(1_000_003)) * F.col("n") <= F.lit(4 * rows * 1_000_003))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = thin.withColumn("rank", rank).where(F.col("rank") <= rows).select("doc_id", "h").distinct()
    chosen = F.broadcast(chosen) if chosen.count() <= 100_000 else chosen
    start = F.pmod("h", F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int") + 1
    found = labelled.join(chosen, "doc_id").select("doc_id", "lang", F.substring("text", start, F.lit(chars)).alias("text"))
    return sorted((r.text, r.lang) for r in found.collect())


def fit(rows: list[tuple[str, str]], rounds: int = ROUNDS) -> LanguageModel:
    """Regularised likelihood of the sample's label sequences, by adaptive gradient steps."""
    languages = tuple(sorted({lang for _, lang in rows}))
    k = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    sequences = [(words, number[lang]) for text, lang in rows for words in lines_of(text)]
    weights, transitions = np.zeros((1 << TABLE_BITS, max(k, 1))), np.zeros((max(k, 1), max(k, 1)))
    if k == 0 or not sequences:
        return LanguageModel(languages, weights, transitions, {})
    flat = [w for words, _ in sequences for w in words]
    lengths = np.array([len(words) for words, _ in sequences])
    codes, unique = pd.factorize(pd.Series(flat, dtype=object))
    truth = np.repeat([y for _, y in sequences], lengths)
    seen = np.zeros((len(unique), k))
    np.add.at(seen, (codes, truth), 1)
    total = seen.sum(axis=1)
    sure = np.flatnonzero((total >= 3) & (seen.max(axis=1) >= 0.8 * total))
    sure = sure[np.lexsort((unique[sure].astype(str), -total[sure]))][:LEXICON_WORDS]
    lexicon = {unique[i]: int(seen[i].argmax()) for i in sure}
    rows_, owners = features(list(unique), lexicon)
    same = np.zeros((k, k))
    for (words, y) in sequences:
        same[y, y] += len(words) - 1
    wg, tg = np.full_like(weights, 1e-8), np.full_like(transitions, 1e-8)
    n = len(flat)
    for _ in range(rounds):
        scores = np.column_stack([np.bincount(owners, w[rows_], len(unique)) for w in weights.T])
        gamma, expected = forward_backward(scores[codes], lengths, transitions, pairs=True)
        miss = -gamma
        miss[np.arange(n), truth] += 1
        by_word = np.column_stack([np.bincount(codes, m, len(unique)) for m in miss.T])
        grad = np.column_stack([np.bincount(rows_, m[owners], len(weights)) for m in by_word.T]) / n - 1e-6 * weights
        step = (same - expected) / n - 1e-2 * transitions
        wg, tg = wg + grad**2, tg + step**2
        weights += 0.3 * grad / np.sqrt(wg)
        transitions += 0.3 * step / np.sqrt(tg)
    return LanguageModel(languages, weights.astype(np.float32), transitions, lexicon)


class Labeller:
    """Labels whole texts; scores of words seen lately are kept."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, max(1, len(self.model.languages))))

    def look_up(self, words: list[str]) -> np.ndarray:
        if len(self.place) > KEPT:
            self.clear()
        new = list(dict.fromkeys(w for w in words if w not in self.place))
        if new:
            self.scores = np.concatenate([self.scores, _emissions(new, self.model.weights, self.model.lexicon)])
            self.place.update(zip(new, range(len(self.place), len(self.scores))))
        place = self.place
        return self.scores[np.fromiter((place[w] for w in words), dtype=np.int64, count=len(words))]

    def chunk(self, texts: list[list[list[str]]]) -> np.ndarray:
        """Mean probability of each language for each text (a list of sequences with words)."""
        words = [w for seqs in texts for s in seqs for w in s]
        lengths = np.array([len(s) for seqs in texts for s in seqs])
        gamma = forward_backward(self.look_up(words), lengths, self.model.transitions)
        sizes = np.array([sum(map(len, seqs)) for seqs in texts])
        ends = np.cumsum(sizes)
        sums = np.concatenate([np.zeros((1, gamma.shape[1])), np.cumsum(gamma, axis=0)])
        return (sums[ends] - sums[ends - sizes]) / sizes[:, None]

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        held: list[list[list[str]]] = []
        owners: list[int] = []
        words = 0

        def flush():
            for i, p in zip(owners, self.chunk(held) if held else ()):
                best = int(p.argmax())
                out[i] = (self.model.languages[best], float(min(1.0, max(0.0, p[best]))))

        if not self.model.languages:
            return out
        for i, text in enumerate(texts):
            seqs = lines_of(text)
            if not seqs:
                continue
            held.append(seqs)
            owners.append(i)
            words += sum(map(len, seqs))
            if words >= CHUNK:
                flush()
                held, owners, words = [], [], 0
        flush()
        return out


def language(text: Column, model: LanguageModel) -> Column:
    """Struct (lang, score) for the whole text.

    ``und`` with score 0 for a null text, a text without a letter, and any text if nothing was
    learned; ties go to the first language in alphabetical order.
    """

    @F.pandas_udf("lang string, score double")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model)
        for texts in batches:
            yield pd.DataFrame(labeller.label(texts.tolist()), columns=["lang", "score"])

    return labelled(text)
