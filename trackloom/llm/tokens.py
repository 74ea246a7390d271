"""Token counts of sections, attributed by offsets.

A document is encoded once, as a whole. The tokens' byte spans, which are sorted, are joined with
the sections' spans by binary search, so that sections get the tokens the document has when it is
trained on, not those they would have alone. A token that crosses a boundary goes by a rule:

- ``first``: to the section of its first byte,
- ``last``: to the section of its last byte,
- ``most``: to the section that holds most of its bytes (ties: the earlier one),
- ``share``: to every section it touches, by its share of the token's bytes.

Tokens outside every section are counted under section -1, so the counts of a document always add
up to its tokens. Defined results: without given sections, lines (with their line feeds) are the
sections; a null or empty text is one section without tokens; sections that overlap are cut where
the one before them ends; repeated rows are counted each.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chat import PATTERN

RULES = ("first", "last", "most", "share")
_COUNTS = "doc_id long, section int, start long, end long, tokens double, doc_tokens long"


class Vocabulary:
    """A byte-level vocabulary and the length of each token in bytes."""

    def __init__(self, ranks_file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for raw, i in ranks.items():
            self.lengths[i] = len(raw)

    def edges(self, text: str) -> np.ndarray:
        """Byte offsets 0, end of token 1, end of token 2, ..."""
        ids = np.array(self.encoding.encode_ordinary(text), dtype=np.int64)
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])


def attribute(edges: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section (byte spans, sorted, apart from each other), and those of none."""
    n = len(edges) - 1
    if rule == "share":
        # tokens up to a byte offset, with the part of the token that the offset cuts
        upto = lambda at: np.interp(at, edges, np.arange(n + 1)) if n else np.zeros(len(at))
        counts = upto(ends) - upto(starts)
        return counts, n - float(counts.sum())
    if rule == "most":
        first, last = edges[:-1], edges[1:] - 1
        a = np.searchsorted(ends, first, side="right")  # the first section that ends behind the token's start
        best, most = np.full(n, -1), np.zeros(n, dtype=np.int64)
        k = a.copy()
        todo = np.flatnonzero(k < len(starts))
        while len(todo):
            todo = todo[starts[k[todo]] <= last[todo]]
            over = np.minimum(ends[k[todo]], last[todo] + 1) - np.maximum(starts[k[todo]], first[todo])
            better = over > most[todo]
            best[todo[better]], most[todo[better]] = k[todo[better]], over[better]
            k[todo] += 1
            todo = todo[k[todo] < len(starts)]
        place = best
    else:
        at = edges[:-1] if rule == "first" else edges[1:] - 1
        place = np.searchsorted(starts, at, side="right") - 1
        inside = (place >= 0) & (at < ends[np.maximum(place, 0)]) if len(starts) else np.zeros(n, dtype=bool)
        place = np.where(inside, place, -1)
    counts = np.bincount(place[place >= 0], minlength=len(starts)).astype(float)
    return counts, float((place < 0).sum())


def _line_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    feeds = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    ends = np.unique(np.concatenate([feeds, [len(data)]]))
    return np.concatenate([[0], ends[:-1]]), ends


def _apart(spans: list, chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Given spans in order, inside the text, and apart; and which of the given each one is."""
    spans = [(min(max(int(a or 0), 0), chars), min(max(int(b or 0), 0), chars), k) for k, (a, b) in enumerate(spans)]
    out, before = [], 0
    for a, b, k in sorted(spans):
        a = max(a, before)
        b = max(a, b)
        before = b
        out.append((a, b, k))
    return tuple(np.array(x, dtype=np.int64) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 3


def section_tokens(
    docs: DataFrame, ranks_file: bytes, doc: str = "doc_id", text: str = "text", sections: str | None = None, rule: str = "first"
) -> DataFrame:
    """One row per section: doc_id, section, start and end (characters), tokens, doc_tokens.

    ``sections`` names a column of arrays of structs (start, end) in characters.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def one(vocabulary: Vocabulary, text_: str, given) -> tuple:
        data = text_.encode()
        edges = vocabulary.edges(text_)
        plain = len(data) == len(text_)
        first = None if plain else np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        if given is None:
            starts, ends = _line_spans(data)
            number = np.arange(len(starts))
        else:
            a, b, number = _apart([(s["start"], s["end"]) for s in given], len(text_))
            to_byte = (lambda c: c) if plain else lambda c: np.append(first, len(data))[c]
            starts, ends = to_byte(a), to_byte(b)
        counts, rest = attribute(edges, starts, ends, rule)
        to_char = (lambda x: x) if plain else lambda x: np.searchsorted(first, x)
        return number, to_char(starts), to_char(ends), counts, rest, len(edges) - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(ranks_file)
        for batch in batches:
            parts = []
            given = batch["sections"] if "sections" in batch else [None] * len(batch)
            for number, text_, spans in zip(batch["doc_id"], batch["text"], given):
                sec, a, b, counts, rest, total = one(vocabulary, text_ or "", spans)
                if rest > 1e-9:
                    sec, a, b, counts = (np.append(x, v) for x, v in ((sec, -1), (a, 0), (b, 0), (counts, rest)))
                parts.append((number, sec, a, b, counts, total))
            if not parts:
                continue
            sizes = [len(p[1]) for p in parts]
            ids = pd.Series([None if pd.isna(p[0]) else int(p[0]) for p in parts], dtype="Int64")
            columns = [np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4)]
            yield pd.DataFrame(
                {
                    "doc_id": ids.repeat(sizes).reset_index(drop=True),
                    "section": columns[0],
                    "start": columns[1],
                    "end": columns[2],
                    "tokens": columns[3],
                    "doc_tokens": np.repeat([p[5] for p in parts], sizes),
                }
            )

    own = [F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")]
    if sections:
        own.append(F.col(sections).alias("sections"))
    return docs.select(*own).mapInPandas(run, _COUNTS)
