"""Token counts by section: offset-mapped attribution.

A whole document is encoded once. Its tokens' byte lengths give their spans, which
are interval-joined to the spans of its sections. A token within one section counts
there. A token that crosses a boundary is given by a rule:

- `largest`: to the section that holds most of its bytes, ties to the earlier one
- `first`: to the section that holds its first byte in any section
- `share`: to all of them, in proportion to the bytes they hold

A token that touches no section counts as outside, section -1. So the sections'
counts sum up to the document's count.

Both joins run within the document, in one pass over the table without a shuffle.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubloom.llm.texts import chunks

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's texts are split into words.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
RULES = ("largest", "first", "share")

Spans = list[tuple[int, int]]  # starts and ends in bytes, in order, without overlap
Arrow = Iterator[pa.RecordBatch]

RESULT = ("doc_id long, section int, name string, start long, end long, n_tokens double, "
          "n_crossing long, doc_tokens long")
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("section", pa.int32()), ("name", pa.string()),
    ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.float64()),
    ("n_crossing", pa.int64()), ("doc_tokens", pa.int64())])


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines `base64 rank`."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def byte_lengths(ranks: dict[bytes, int]) -> np.ndarray:
    out = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        out[rank] = len(token)
    return out


#: Runs of white space longer than this are taken out before the pattern sees them.
PIECE = 10_000
#: White space as the pattern has it.
_SPACES = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{3,}")


class Encoder:
    """Tokens of whole texts, from pieces that together have the same.

    The pattern takes a run of white space whole but for its last character, which goes
    with the word behind it or stands alone; at the end of the text, whole. Its search is
    too deep for very long runs, so what it would take is encoded as one match.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks,
                                       special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks,
                                       special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        tokens, start = [], 0
        for run in _SPACES.finditer(text):
            first, last = run.span()
            if last - first > PIECE:
                stop = last if last == len(text) else last - 1
                tokens += self.words.encode_ordinary(text[start:first])
                tokens += self.whole.encode_ordinary(text[first:stop])
                start = stop
        return np.array(tokens + self.words.encode_ordinary(text[start:]), np.int64)


def line_spans(data: bytes) -> Spans:
    """The lines of a text, each with the newline that ends it."""
    spans, start = [], 0
    while start < len(data):
        end = data.find(b"\n", start) + 1 or len(data)
        spans.append((start, end))
        start = end
    return spans


def attributed(lengths: np.ndarray, spans: Spans, rule: str) -> tuple[np.ndarray, ...]:
    """Tokens and crossing tokens of each section, those outside last.

    `lengths` are the tokens' bytes in order.
    """
    n = len(spans)
    counts, crossing = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    bounds = np.array(spans, np.int64).reshape(-1, 2)
    low = np.searchsorted(bounds[:, 1], starts, side="right")
    high = np.searchsorted(bounds[:, 0], ends, side="left")
    touched = high - low
    counts += np.bincount(low[touched == 1], minlength=n + 1)
    counts[n] += int((touched <= 0).sum())
    for i in np.flatnonzero(touched > 1).tolist():
        sections = np.arange(low[i], high[i])
        held = (np.minimum(ends[i], bounds[sections, 1])
                - np.maximum(starts[i], bounds[sections, 0]))
        crossing[sections] += 1
        if rule == "share":
            counts[sections] += held / held.sum()
        else:
            counts[sections[int(held.argmax()) if rule == "largest" else 0]] += 1
    return counts, crossing


def _code_points(data: bytes) -> np.ndarray:
    """The code points that start before each byte, and their number."""
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(first)))


def _in_bytes(data: bytes, sections: list[dict]) -> tuple[list[str | None], Spans]:
    """Named spans in code points, cut to the text and put in order, in bytes."""
    at = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
    names, spans, last = [], [], 0
    for s in sorted(sections, key=lambda s: (s["start"], s["end"])):
        start, end = (int(at[min(max(s[k], 0), len(at) - 1)]) for k in ("start", "end"))
        start = max(start, last)
        if start < end:
            names.append(s["name"]), spans.append((start, end))
            last = end
    return names, spans


def _counted(vocabulary, pattern: str, rule: str, named: bool) -> Callable[[Arrow], Arrow]:
    def run(batches: Arrow) -> Arrow:
        ranks = vocabulary.value
        encoder = Encoder(ranks, pattern)
        sizes = byte_lengths(ranks)
        for batch in batches:
            for part in chunks(batch):
                columns: list[list] = [[] for _ in _RESULT]
                ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                given = part.column("sections").to_pylist() if named else [None] * len(ids)
                for doc_id, text, sections in zip(ids, texts, given, strict=True):
                    data = (text or "").encode()
                    tokens = encoder.encode(text or "")
                    if named:
                        names, spans = _in_bytes(data, [s for s in sections or [] if s])
                    else:
                        spans = line_spans(data)
                        names = [None] * len(spans)
                    counts, crossing = attributed(sizes[tokens], spans, rule)
                    rows = len(spans)
                    points = _code_points(data)
                    bounds = points[np.array(spans, np.int64).reshape(-1, 2)]
                    values = [[doc_id] * rows, list(range(rows)), names, bounds[:, 0].tolist(),
                              bounds[:, 1].tolist(), counts[:-1].tolist(),
                              crossing[:-1].tolist(), [len(tokens)] * rows]
                    if counts[-1] or not rows:
                        for v, more in zip(values, (doc_id, -1, None, 0, 0, float(counts[-1]), 0,
                                                    len(tokens)), strict=True):
                            v.append(more)
                    for column, v in zip(columns, values, strict=True):
                        column.extend(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)],
                    schema=_RESULT)
    return run


def section_tokens(docs: DataFrame, sections: str | None = None, rule: str = "largest",
                   vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id, section, name, start, end, n_tokens, n_crossing, doc_tokens.

    One row for each section of each document: its number in order of place, its
    span in code points (end exclusive), its tokens by `rule` and how many of them
    cross its boundary, and the tokens of the whole document. Sections are the lines
    of the text with their newlines, or the column `sections`, an array of structs
    name, start, end in code points. These are cut to the text; where two overlap,
    the earlier keeps the overlap. Tokens outside all sections are a row with
    section -1, which a document without sections, null and empty texts included,
    always has. Rows are independent: equal rows give equal results. The vocabulary
    is a file on the driver of a few MB, sent to each worker.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")]
    if sections:
        columns.append(F.col(sections).cast(
            "array<struct<name:string,start:bigint,end:bigint>>").alias("sections"))
    return docs.select(*columns).mapInArrow(
        _counted(sent, pattern, rule, bool(sections)), RESULT)
