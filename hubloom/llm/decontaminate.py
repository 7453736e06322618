"""Benchmark decontamination: suffix arrays over the training text.

Words are runs of bytes other than ASCII non-alphanumerics, lower-cased in A-Z:
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. A window is WINDOW consecutive words of a test
item; an item of fewer, but not none, is one window. A training word inside any
occurrence of a window is hit, and a document with a hit is contaminated.

Training text is cut into shards of whole documents, CHUNK_BYTES each. A shard's
words are numbered by the test set's vocabulary, other words end a run, and runs
too short for any window are left out, as no test suffix can match there. The
remaining suffixes are sorted by doubling: by their first word, 2, 4 words and so
on up to WINDOW. Every test suffix is looked up by its first WINDOW words, by binary
search in the order of that length. Where the next suffix of the item is found at the
next place, the match goes on, so the places of one item on one diagonal chain up to its
longest verbatim matches, with their places in document and item.

A shard holds whole documents, so training text is read once and never shuffled.
The test set is sent to tasks in blocks of whole items below BLOCK_BYTES. With more than
one block the rows are written once, with a number each; each block then takes a pass
that gives the hits of those documents that have any, and these are merged by number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubloom.llm.rows import Carried
from hubloom.llm.texts import chunks, coded
from hubloom.session import keep as store

WINDOW = 10
BLOCK_BYTES = 16 << 20

Arrow = Iterator[pa.RecordBatch]

#: Every byte that is no word's becomes a space, A-Z become a-z.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TO_WORDS).split() if text else []


class Numbers(dict):
    """word -> number in the test set's vocabulary; 0 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Windows(NamedTuple):
    """The distinct windows of one length, and where the items have them.

    Occurrences of window i are those from starts[i] on: number of the item's sequence
    of words, and place of the window in it.
    """

    words: np.ndarray
    starts: np.ndarray
    sequences: np.ndarray
    places: np.ndarray


class Tests(NamedTuple):
    """Some test items: their vocabulary, their windows, the items of each sequence."""

    numbers: dict[bytes, int]
    windows: list[Windows]
    names: list[list[str]]


def test_windows(items: list[tuple[str, bytes]]) -> Tests:
    """Items with equal words are one sequence of words."""
    numbers: dict[bytes, int] = {}
    sequences: dict[tuple[int, ...], list[str]] = {}
    for name, text in items:
        words = tuple(numbers.setdefault(w, len(numbers) + 1) for w in words_of(text))
        if words:
            sequences.setdefault(words, []).append(name)
    found: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = {}
    for number, words in enumerate(sequences):
        length = min(WINDOW, len(words))
        of_length = found.setdefault(length, {})
        for i in range(len(words) - length + 1):
            of_length.setdefault(words[i:i + length], []).append((number, i))
    windows = []
    for length, of_length in found.items():
        flat = np.array([p for places in of_length.values() for p in places], np.int64)
        windows.append(Windows(
            np.array(list(of_length), np.int64).reshape(-1, length),
            np.concatenate(([0], np.cumsum([len(p) for p in of_length.values()]))),
            flat[:, 0], flat[:, 1]))
    return Tests(numbers, windows, [sorted(set(n)) for n in sequences.values()])


class SuffixArray:
    """Suffixes of a shard that stay in the vocabulary, sorted by doubling.

    rank(n) numbers the places by their first n words, 0 where a word outside the
    vocabulary or the document's end comes first; equal sequences have equal
    numbers, and the numbers follow the order of the words.
    """

    def __init__(self, numbers: np.ndarray, starts: np.ndarray) -> None:
        spaced = np.zeros(len(numbers) + len(starts), np.int64)  # a gap after each document
        of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.at = np.arange(len(numbers)) + of
        spaced[self.at] = numbers
        self.document = np.full(len(spaced), -1, np.int64)
        self.document[self.at] = of
        self.ranks = {1: spaced}
        self.keys: dict[int, tuple[int, int, np.ndarray]] = {}

    def rank(self, n: int) -> np.ndarray:
        if n not in self.ranks:
            half = 1 << ((n - 1).bit_length() - 1)
            left, right = self.rank(half), self.rank(n - half)
            there = np.flatnonzero((left[:max(0, len(left) - half)] > 0) & (right[half:] > 0))
            pairs = left[there] << 32 | right[there + half]
            keys, inverse = np.unique(pairs, return_inverse=True)
            ranks = np.zeros(len(left), np.int64)
            ranks[there] = inverse + 1
            self.ranks[n], self.keys[n] = ranks, (half, n - half, keys)
        return self.ranks[n]

    def find(self, sequences: np.ndarray) -> np.ndarray:
        """Ranks of sequences (one a row, all of one length) by binary search."""
        n = sequences.shape[1]
        if n == 1:
            return sequences[:, 0]
        self.rank(n)
        half, rest, keys = self.keys[n]
        left, right = self.find(sequences[:, :half]), self.find(sequences[:, half:])
        pairs = left << 32 | right
        at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
        found = (left > 0) & (right > 0) & (len(keys) > 0)
        if len(keys):
            found &= keys[at] == pairs
        return np.where(found, at + 1, 0)

    def places(self, n: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and index into `wanted` of every suffix that has such a rank."""
        ranks = self.rank(n)
        highest = max(int(ranks.max(initial=0)), int(wanted.max(initial=0)))
        known = np.zeros(highest + 1, np.int64)
        present = np.flatnonzero(wanted > 0)
        known[wanted[present]] = present + 1
        hits = known[ranks]
        at = np.flatnonzero(hits)
        return at, hits[at] - 1


class Match(NamedTuple):
    """A longest verbatim match of an item: words, first word in document and item."""

    length: int
    word: int
    item_word: int


def _chained(documents: np.ndarray, places: np.ndarray, sequences: np.ndarray,
             offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, Match]]:
    """Document, sequence and match for each run of windows that follow each other in
    both; the longest come first, then the earliest."""
    order = np.lexsort((places, places - offsets, sequences, documents))
    documents, places, sequences, offsets = (
        x[order] for x in (documents, places, sequences, offsets))
    goes_on = ((documents[1:] == documents[:-1]) & (sequences[1:] == sequences[:-1])
               & (places[1:] == places[:-1] + 1) & (offsets[1:] == offsets[:-1] + 1))
    first = np.concatenate(([0], np.flatnonzero(~goes_on) + 1))
    lengths = np.diff(np.append(first, len(places))) - 1 + length
    for i in np.lexsort((offsets[first], places[first], -lengths)).tolist():
        at = first[i]
        yield int(documents[at]), int(sequences[at]), Match(
            int(lengths[i]), int(places[at]), int(offsets[at]))


def shard_hits(lists: list[list[bytes]], numbers: Numbers, tests: Tests
               ) -> tuple[np.ndarray, np.ndarray, dict[int, dict[str, Match]]]:
    """Which words are hit, where each text starts, and the items found in each text
    with the longest match of each; of equally long ones the earliest."""
    flat, starts = coded(lists, numbers)
    array = SuffixArray(flat.astype(np.int64), starts)
    edges = np.zeros(len(array.document) + WINDOW + 1, np.int64)
    found: dict[int, dict[str, Match]] = {}
    for windows in tests.windows:
        length = windows.words.shape[1]
        at, which = array.places(length, array.find(windows.words))
        if not len(at):
            continue
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
        times = windows.starts[which + 1] - windows.starts[which]
        of = np.repeat(np.arange(len(at)), times)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        occurrence = windows.starts[which[of]] + nth
        documents = array.document[at[of]]
        # Documents are apart by one place each in the array.
        places = at[of] - documents - starts[documents]
        for document, sequence, match in _chained(
                documents, places, windows.sequences[occurrence], windows.places[occurrence],
                length):
            items = found.setdefault(document, {})
            for name in tests.names[sequence]:
                items[name] = _longer(items.get(name), match)
    return np.cumsum(edges)[array.at] > 0, starts, found


def _longer(one: Match | None, other: Match) -> Match:
    if one is None:
        return other
    return min(one, other, key=lambda m: (-m.length, m.word, m.item_word))


_MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("word", T.LongType()), T.StructField("item_word", T.LongType())]))
#: What one block of the test set tells of a document that it hits.
HITS = T.StructType([T.StructField("hit", T.BinaryType()), T.StructField("matches", _MATCHES)])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("longest_match", T.LongType()), T.StructField("match_word", T.LongType()),
    T.StructField("matches", _MATCHES)])
_MATCHES_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("length", pa.int64()),
                                     ("word", pa.int64()), ("item_word", pa.int64())]))


def _listed(items: dict[str, Match]) -> list[dict]:
    return [{"item_id": name, **items[name]._asdict()} for name in sorted(items)]


def _found(hits: list[np.ndarray], items: list[dict[str, Match]]) -> list[pa.Array]:
    best = [min(found.values(), key=lambda m: (-m.length, m.word)) if found else Match(0, -1, -1)
            for found in items]
    digests = [hashlib.sha256(",".join(sorted(n)).encode()).hexdigest() for n in items]
    return [pa.array([len(h) for h in hits], pa.int64()),
            pa.array([int(h.sum()) for h in hits], pa.int64()),
            pa.array([len(n) for n in items], pa.int64()), pa.array(digests, pa.string()),
            pa.array([bool(h.any()) for h in hits], pa.bool_()),
            pa.array([m.length for m in best], pa.int64()),
            pa.array([m.word for m in best], pa.int64()),
            pa.array([_listed(n) for n in items], _MATCHES_ARROW)]


def _read(batches: Arrow, block) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """Parts of batches, with the hit words and found items of each text."""
    numbers = Numbers(block.value.numbers)
    for batch in batches:
        for part in chunks(batch, "bytes"):
            lists = [words_of(t) for t in part.column("bytes").to_pylist()]
            flat, starts, found = shard_hits(lists, numbers, block.value)
            hits = [flat[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield part, hits, [found.get(i, {}) for i in range(len(lists))]


def _whole(block) -> Callable[[Arrow], Arrow]:
    """The results of rows of row and bytes, by the only block there is."""
    def run(batches: Arrow) -> Arrow:
        for part, hits, items in _read(batches, block):
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), *_found(hits, items)], ["row", *FOUND.names])
    return run


def _partial(block) -> Callable[[Arrow], Arrow]:
    """Number and hits of the documents that a block hits."""
    def run(batches: Arrow) -> Arrow:
        for part, hits, items in _read(batches, block):
            some = [i for i, found in enumerate(items) if found]
            yield pa.RecordBatch.from_arrays(
                [part.column("at").take(pa.array(some, pa.int64())),
                 pa.array([np.packbits(hits[i]).tobytes() for i in some], pa.binary()),
                 pa.array([_listed(items[i]) for i in some], _MATCHES_ARROW)],
                ["at", *HITS.names])
    return run


def _merged(batches: Arrow) -> Arrow:
    """The results of rows of row, bytes and the blocks' hits."""
    for batch in batches:
        for part in chunks(batch, "bytes"):
            hits, items = [], []
            for text, blocks in zip(part.column("bytes").to_pylist(),
                                    part.column("blocks").to_pylist(), strict=True):
                hit, found = np.zeros(len(words_of(text)), bool), {}
                for block in blocks or []:
                    hit |= np.unpackbits(np.frombuffer(block["hit"], np.uint8),
                                         count=len(hit)).astype(bool)
                    for m in block["matches"]:
                        found[m["item_id"]] = _longer(found.get(m["item_id"]), Match(
                            m["length"], m["word"], m["item_word"]))
                hits.append(hit), items.append(found)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), *_found(hits, items)], ["row", *FOUND.names])


def _blocks(spark: SparkSession, tests: DataFrame) -> Iterator[Broadcast]:
    """The test set in broadcast blocks, each gathered within BLOCK_BYTES.

    One item longer than that shares a block with few others.
    """
    items = tests.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
                         F.col("text").cast("binary").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.length("text") + F.length("name") + 64)).first()[0] or 0
    n = max(1, -(-2 * size // BLOCK_BYTES))
    split = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(n)))
    for i in range(n):
        rows = split.where(F.col("block") == i).collect()
        yield spark.sparkContext.broadcast(test_windows([(r.name, bytes(r.text)) for r in rows]))


def _results(docs: DataFrame, tests: DataFrame) -> tuple[Carried, DataFrame]:
    """The caller's rows with the columns of FOUND."""
    spark, carried = docs.sparkSession, Carried(docs)
    rows = carried.rows(bytes=F.col("text").cast("binary"))
    blocks = list(_blocks(spark, tests))
    schema = T.StructType([rows.schema["row"], *FOUND.fields])
    if len(blocks) == 1:
        return carried, rows.mapInArrow(_whole(blocks[0]), schema)
    rows = store(spark, rows.withColumn("at", F.monotonically_increasing_id()), "numbered")
    hits = None
    for block in blocks:
        found = store(spark, rows.select("at", "bytes").mapInArrow(
            _partial(block), T.StructType([T.StructField("at", T.LongType()), *HITS.fields])), "hits")
        hits = found if hits is None else hits.unionAll(found)
    hits = hits.groupBy("at").agg(F.collect_list(F.struct(*HITS.names)).alias("blocks"))
    return carried, rows.join(hits, "at", "left").select("row", "bytes", "blocks").mapInArrow(
        _merged, schema)


def matched(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """`docs` with what of the test set they hold.

    Adds n_words, n_hit, n_items, items_sha256 (of the ids of found items, sorted as
    strings, comma-joined), contaminated, matches, longest_match and match_word; columns
    of these names, in any spelling, are replaced. matches has the longest verbatim match
    of each found item, in the order of their ids: its words, and the numbers of its first
    word in document and item; of equally long ones the earliest. longest_match and
    match_word are those of the longest of all (0 and -1 if none). Reads docs.text,
    tests.item_id and tests.text. Null and empty texts have no words; a null item_id is
    written as the empty string; items that share an id count once. An empty test set
    finds nothing.
    """
    carried, rows = _results(docs, tests)
    return rows.select(*carried.columns(FOUND.names), *FOUND.names)


def clean(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no window of the test set, as they are."""
    carried, rows = _results(docs, tests)
    return rows.where("not contaminated").select(*carried.columns())
