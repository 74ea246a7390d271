"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<turn>role<body>text</turn>`` and a line feed for each turn. The
three markers are single tokens; inside roles and texts a marker is broken by a backslash after
its ``<`` (one more if there are some already), which is undone when reading back. Everything is
encoded once; sorted spans of assistant texts are placed on the sorted token spans by binary
search, and the tokens inside them carry the loss.

Turns are ordered by ``turn`` (nulls first), then role and text; null roles and texts are empty.
Rows are streamed in that order, cut into segments at turn ends, so that a conversation of any
length needs the memory of one segment (or of its longest text) only.
"""

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: the pre-splitting pattern of the public byte-level vocabulary (fixed value)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TURN, BODY, END = "<turn>", "<body>", "</turn>"
_CONTROL = re.compile(r"<(\\*)(turn>|body>|/turn>)")
_ESCAPED = re.compile(r"<\\(\\*)(turn>|body>|/turn>)")
SEGMENT_CHARS = 1 << 20
SEGMENTS = (
    "conv_id long, segment long, n_turns long, formatted string, "
    "token_ids array<int>, token_ends array<int>, loss_mask array<boolean>"
)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1\2", text)


class Codec:
    """A byte-level vocabulary with the three markers as tokens of their own."""

    def __init__(self, ranks_file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        top = max(ranks.values()) + 1
        self.special = {m: top + i for i, m in enumerate((TURN, BODY, END))}
        self.encoding = tiktoken.Encoding(
            "chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        self.lengths = np.zeros(top + 3, dtype=np.int64)
        for raw, i in [*ranks.items(), *((m.encode(), i) for m, i in self.special.items())]:
            self.lengths[i] = len(raw)

    def encode(self, rendered: str) -> tuple[np.ndarray, np.ndarray]:
        """Token ids and the byte offsets where they end."""
        ids = np.array(self.encoding.encode(rendered, allowed_special="all"), dtype=np.int64)
        return ids, np.cumsum(self.lengths[ids]) if len(ids) else ids


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns, and the byte spans of assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body, tail = f"{TURN}{escape(role)}{BODY}", escape(text), f"{END}\n"
        start = at + len(head.encode())
        end = start + len(body.encode())
        if role == "assistant":
            spans.append((start, end))
        parts += (head, body, tail)
        at = end + len(tail.encode())
    return "".join(parts), spans


def mask(ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for the tokens inside a span; spans are sorted and begin and end with tokens."""
    loss = np.zeros(len(ends), dtype=bool)
    if len(ends) and spans:
        starts = np.concatenate([[0], ends[:-1]])
        s = np.array(spans)
        first = np.searchsorted(starts, s[:, 0], side="left")
        after = np.searchsorted(ends, s[:, 1], side="right")
        for a, b in zip(first, after):
            loss[a:b] = True
    return loss


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the rows of a conversation together, in order."""
    keep = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return keep.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _id(value) -> int | None:
    return None if pd.isna(value) else int(value)


def format_conversations(conversations: DataFrame, ranks_file: bytes, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row per segment, the segments of a conversation in order (``SEGMENTS``).

    ``token_ends`` are byte offsets in ``formatted``. Rows without an id make up one conversation
    of their own; repeated rows are repeated turns; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(ranks_file)

        def segment(conv, number, turns):
            rendered, spans = render(turns)
            ids, ends = codec.encode(rendered)
            return (conv, number, len(turns), rendered, ids.astype("int32"), ends.astype("int32"), mask(ends, spans))

        columns = ["conv_id", "segment", "n_turns", "formatted", "token_ids", "token_ends", "loss_mask"]

        def frame(rows):
            out = pd.DataFrame(rows, columns=columns)
            return out.astype({"conv_id": "Int64"})

        current, number, turns, chars, out, held = (), 0, [], 0, [], 0
        for batch in batches:
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                conv = _id(conv)
                if turns and (current != (conv,) or chars >= segment_chars):
                    out.append(segment(current[0], number, turns))
                    held += chars
                    number, turns, chars = number + 1, [], 0
                    if held >= segment_chars:
                        yield frame(out)
                        out, held = [], 0
                if current != (conv,):
                    current, number = (conv,), 0
                turns.append((role, text))
                chars += len(role) + len(text)
        if turns:
            out.append(segment(current[0], number, turns))
        if out:
            yield frame(out)

    return ordered(conversations).mapInPandas(run, SEGMENTS)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, as they were before."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, rest = part.partition(BODY)
        turns.append((unescape(role), unescape(rest[: rest.index(END)])))
    return turns


def loss_texts(formatted: str, ends: np.ndarray, loss: np.ndarray) -> str:
    """The unescaped text under the mask; each run of marked tokens is one text."""
    if not loss.any():
        return ""
    data = formatted.encode()
    starts = np.concatenate([[0], ends[:-1]])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
    return "".join(unescape(data[starts[a] : ends[b - 1]].decode()) for a, b in zip(edge[::2], edge[1::2]))


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation (``DIGEST``), read back from its segments in their order.

    Takes the direct output of ``format_conversations``: segments of a conversation are adjacent.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                conv = _id(row.conv_id)
                if state is None or state[0] != conv:
                    if state:
                        out.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(row.formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                under = loss_texts(row.formatted, np.asarray(row.token_ends), np.asarray(row.loss_mask, dtype=bool))
                state[3] += len(under)
                state[4].update(under.encode())
                state[5] += len(row.formatted)
            if out:
                yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
        if state:
            last = (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])
            yield pd.DataFrame([last], columns=names).astype({"conv_id": "Int64"})

    return segments.mapInPandas(run, DIGEST)
