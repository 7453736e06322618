"""Packing documents into sequences of tokens along a space-filling curve.

1. Every document is encoded once, word by word, and its ids are kept. Its tokens are
   hashed into a signed vector of WIDTH counts, damped by logarithms and of length one,
   which is projected to DIMENSIONS numbers by a fixed random matrix.
2. Means and spreads of these numbers over all documents, as exact sums, stretch them to
   a grid of 2 ** BITS cells a side. The cell's place on the Hilbert curve is the key.
3. Narrow rows are range-sorted by the key. Equal keys, such as those of copies, go on
   by a hash of the doc_id and the row's number, so that no group of them needs a single task. Running
   sums within each range and the ranges' totals give the place of each document in one
   long row of tokens.
4. That row is cut every `length` tokens; the remainder is cut into powers of two, which
   need no padding. So neighbours on the curve share sequences, and nothing is padded.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hubloom.llm.texts import chunks, mixed
from hubloom.session import keep

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
LENGTH, END = 4096, 2
#: Cells of the hashed vector, numbers it is projected to, bits of each on the grid.
WIDTH, DIMENSIONS, BITS = 256, 4, 15
#: Projected numbers are whole multiples of 1 / UNIT, so that their sums are exact.
UNIT = 1 << 20
#: Words whose ids a task remembers, words encoded and characters split at a time.
REMEMBERED, AT_ONCE, SPLIT_AT_ONCE = 1_000_000, 20_000, 1 << 20
#: Rows of a range of the curve.
RANGE_ROWS = 1_000_000

Arrow = Iterator[pa.RecordBatch]

_ENCODED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()),
                      ("spot", pa.list_(pa.int64()))])
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64())])


class Words(dict):
    """word -> the bytes of its ids, both as bytes.

    The tokenizer splits at white space, drops it and joins nothing across it; it has
    composed and lower-cased all letters before. So a text is lower-cased as far as it is
    ASCII and cut at spaces and newlines. A plain word, small letters that are neither
    changed nor split, with at most one mark behind them, goes to the tokenizer's model
    at once. All others that are new are encoded as one text, with a mark between them
    whose id no other word has; those that hold it, alone.
    """

    BETWEEN = b"|"
    #: What special tokens start with; they are matched before letters are lower-cased.
    SPECIAL = b"<|"
    LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\n", b"abcdefghijklmnopqrstuvwxyz ")
    PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,]?)")

    def __init__(self, tokenizer: Tokenizer, code: str) -> None:
        self.tokenizer, self.code = tokenizer, code
        (self.between,) = self._ids(self.BETWEEN)
        self.marks = {mark: array(code, self._ids(mark.encode())).tobytes()
                      for mark in ("", ".", ",")}
        self.tokenize = tokenizer.model.tokenize
        # How the model spells letters.
        self.spelled = {ord(c): tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
                        for c in map(chr, range(256)) if self.PLAIN.fullmatch(c)}

    def _ids(self, text: bytes) -> list[int]:
        return self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids

    def _plain(self, letters: str) -> bytes:
        spelled = letters if letters.isascii() else letters.translate(self.spelled)
        return array(self.code, [token.id for token in self.tokenize(spelled)]).tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Know these words; all others are forgotten when there are too many."""
        new = [word for word in words if word not in self]
        if len(self) + 2 * len(new) > REMEMBERED:
            self.clear()
            new = list(words)
        others = []
        for word in new:
            plain = self.PLAIN.fullmatch(word.decode())
            if not plain:
                others.append(word)
            elif plain[2]:
                letters = word[:-1]
                raw = self.get(letters)
                if raw is None:
                    raw = self[letters] = self._plain(plain[1])
                self[word] = raw + self.marks[plain[2]]
            elif word not in self:
                self[word] = self._plain(plain[1])
        between = b" " + self.BETWEEN + b" "
        together = [word for word in others if self.BETWEEN not in word]
        for i in range(0, len(together), AT_ONCE):
            some = together[i:i + AT_ONCE]
            ids = np.array(self._ids(between.join(some)), np.dtype(self.code))
            ends = [*(np.flatnonzero(ids == self.between) * ids.itemsize).tolist(), ids.nbytes]
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, ends, strict=True):
                self[word] = raw[start:end]
                start = end + ids.itemsize
        for word in others:
            if self.BETWEEN in word:
                self[word] = array(self.code, self._ids(word)).tobytes()


def encoded(texts: list[bytes | None], words: Words) -> list[np.ndarray]:
    """The ids of each text."""
    lists = [(text.replace(b"\n", b" ") if words.SPECIAL in text else text.translate(
        words.LOWER)).split(b" ") if text else [] for text in texts]
    words.learn(set(chain.from_iterable(lists)))
    dtype = np.dtype(words.code)
    return [np.frombuffer(b"".join(map(words.__getitem__, some)), dtype) for some in lists]


def hashed_cells(n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """For each id the cell of the hashed vector and the sign it counts with."""
    codes = mixed(np.arange(1, n_ids + 1, dtype=np.uint64))
    return ((codes >> np.uint64(8)) % np.uint64(WIDTH)).astype(np.int64), \
        np.where(codes & np.uint64(1), 1.0, -1.0)


def spots(lists: list[np.ndarray], cells: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Where each document lies in few dimensions, in whole units; zeros without ids."""
    vectors = np.zeros((len(lists), WIDTH))
    for i, ids in enumerate(lists):
        if len(ids):
            vectors[i] = np.bincount(cells[ids], signs[ids], WIDTH)
    vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    matrix = np.random.default_rng(11).standard_normal((WIDTH, DIMENSIONS))
    return np.rint(vectors / np.maximum(norms, 1e-9) @ matrix * UNIT).astype(np.int64)


def _encode(vocabulary, end: int) -> Callable[[Arrow], Arrow]:
    def run(batches: Arrow) -> Arrow:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(vocabulary.value)
        n_ids = max(tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        code = "H" if n_ids <= 1 << 16 else "I"
        cells, signs = hashed_cells(n_ids)
        codec = pa.Codec("zstd", compression_level=1)
        words = Words(tokenizer, code)
        for batch in batches:
            for part in chunks(batch, size=SPLIT_AT_ONCE):
                lists = encoded(part.column("text").to_pylist(), words)
                ended = [np.append(ids, ids.dtype.type(end)) for ids in lists]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(len, ended), pa.int64()),
                     pa.array((codec.compress(ids.tobytes(), asbytes=True) for ids in ended),
                              pa.binary()),
                     pa.array(list(spots(lists, cells, signs)), pa.list_(pa.int64()))],
                    schema=_ENCODED)
    return run


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers below 2 ** bits.

    The high bits decide first: what they say about a cell's orientation is undone in
    the bits below, then the Gray code of the bits, read across, is the place.
    """
    x = points.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for row in x:
            swap = np.where((row >> bit) & 1, 0, (x[0] ^ row) & below)
            flip = np.where((row >> bit) & 1, below, 0)
            row ^= swap
            x[0] ^= swap ^ flip
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x ^ turned:
            place = place << 1 | (row >> bit) & 1
    return place


def _keyed(means: list[float], spreads: list[float]) -> Callable[[Arrow], Arrow]:
    """Puts the key in the place of the spot."""
    def run(batches: Arrow) -> Arrow:
        for batch in batches:
            flat = batch.column("spot").flatten().to_numpy(zero_copy_only=False)
            z = (flat.reshape(-1, DIMENSIONS) - np.array(means)) / np.array(spreads)
            # Near enough to the normal distribution to fill the grid evenly.
            share = 1 / (1 + np.exp(-1.702 * np.clip(z, -8, 8)))
            cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("n"), batch.column("tie"),
                 pa.array(hilbert(cells, BITS))], ["row", "n", "tie", "key"])
    return run


def _running(batches: Arrow) -> Arrow:
    """The tokens before each row within its range."""
    done = 0
    for batch in batches:
        n = batch.column("n").to_numpy(zero_copy_only=False)
        ends = done + np.cumsum(n)
        done = int(ends[-1]) if len(ends) else done
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("range"), batch.column("n"),
             pa.array(ends - n, pa.int64())], ["row", "range", "n", "before"])


def starts_of_tail(total: int, length: int) -> np.ndarray:
    """Where the sequences behind the last full one start, and where they end."""
    left = total % length
    sizes = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    return np.cumsum([total - left, *sizes], dtype=np.int64)


def _cut(total: int, length: int, wide: bool) -> Callable[[Arrow], Arrow]:
    tail = starts_of_tail(total, length)
    full = total // length

    def sequence_of(place: int) -> tuple[int, int, int]:
        """Number, start and end of the sequence that holds a place."""
        if place < tail[0]:
            start = place // length * length
            return place // length, start, start + length
        i = int(np.searchsorted(tail, place, side="right")) - 1
        return full + i, int(tail[i]), int(tail[i + 1])

    def run(batches: Arrow) -> Arrow:
        codec = pa.Codec("zstd")
        dtype = np.dtype(np.uint32 if wide else np.uint16)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, n, packed_ids, at in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "at")),
                    strict=True):
                raw = codec.decompress(packed_ids, n * dtype.itemsize, asbytes=True)
                ids = np.frombuffer(raw, dtype).astype("<u4")
                start = 0
                while start < n:
                    number, first, end = sequence_of(at + start)
                    size = min(end - at - start, n - start)
                    rows.append((doc_id, start, size, ids[start:start + size].tobytes(), n,
                                 number, at + start - first))
                    held += 4 * size
                    start += size
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)],
        schema=_PIECES)


def packed(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY,
           end: int = END) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: pieces of documents.

    A document is the ids of its text (null: no text) and the id `end`. Each of its ids
    lies in one piece: `start` ids come before the piece, `ids` are its own, as unsigned
    32-bit numbers, the low byte first, and `offset` is the piece's place in its
    sequence. Sequences are numbered from 0 and hold `length` ids; those that hold the
    last ids of all are as long as powers of two. So there are up to log2(length) of
    these, and no padding at all.

    Rows are documents: repeated and null doc_ids are documents of their own, equal
    rows lie anywhere among each other. Other columns take no part. Without documents
    there are no pieces. Special tokens that a text spells out are encoded as the
    tokenizer does by itself. The vocabulary is a file of a few MB on the driver.
    """
    if length < 1:
        raise ValueError("length must be at least 1")
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    n_ids = max(Tokenizer.from_str(text).get_vocab_size(with_added_tokens=True), end + 1)
    sent = spark.sparkContext.broadcast(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        _encode(sent, end), "doc_id long, n long, ids binary, spot array<long>")
    rows = keep(spark, rows.withColumn("row", F.monotonically_increasing_id()), "encoded")

    exact = "decimal(38,0)"
    sums = [f(F.col("spot")[i].cast(exact)) for i in range(DIMENSIONS)
            for f in (F.sum, lambda x: F.sum(x * x))]
    count, total, *sums = rows.agg(F.count("*"), F.sum("n"), *sums).first()
    if not count:
        return spark.createDataFrame([], "doc_id long, start long, length long, ids binary, "
                                         "doc_tokens long, sequence_id long, offset long")
    means = [float(s / count) for s in sums[::2]]
    spreads = [max(float(q / count) - m * m, 1.0) ** 0.5
               for m, q in zip(means, sums[1::2], strict=True)]
    keyed = rows.select("row", "n", F.xxhash64("doc_id").alias("tie"), "spot").mapInArrow(
        _keyed(means, spreads), "row long, n long, tie long, key long")
    order = ["key", "tie", "row"]
    ranges = max(1, -(-count // RANGE_ROWS),
                 int(spark.conf.get("spark.sql.shuffle.partitions")))
    places = keep(spark, keyed.repartitionByRange(ranges, *order).sortWithinPartitions(
        *order).withColumn("range", F.spark_partition_id()).select("row", "range", "n").mapInArrow(
        _running, "row long, range int, n long, before long"), "curve")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as there are ranges.
    totals = places.groupBy("range").agg(F.sum("n").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    places = places.join(F.broadcast(totals), "range").select(
        "row", (F.col("first") + F.col("before")).alias("at"))
    return rows.select("row", "doc_id", "n", "ids").join(places, "row").select(
        "doc_id", "n", "ids", "at").mapInArrow(
        _cut(int(total), length, n_ids > 1 << 16),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long")
