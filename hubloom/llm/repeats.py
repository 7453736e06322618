"""Substring dedup: equal windows of words, grouped by leading bits of their codes.

A window is WINDOW consecutive words of one document. A word goes if a window
that covers it also starts earlier, in a smaller doc_id or earlier in the same
document. Windows are judged on the input.

1. *Which windows can repeat.* Each window picks, among the PREFIX-word
   sequences in it, the one with the least hash; equal windows pick equal ones.
   Only the picked places, about one in seven, are counted over the whole corpus.
   Windows whose picked sequence occurs once cannot repeat and are left.
2. *Groups.* Each remaining window is labelled by 128 bits, the codes of its first and
   its second ten words. Windows are split by leading bits of the first code into groups;
   their number follows from the size of the corpus. Above MOST_GROUPS a group is dealt
   out once more, by further bits, before any task gathers it.
3. *Repeats.* Within a group, windows are sorted by their labels. Neighbours with one
   label are a repeat. All but the earliest are removed; overlapping ones merge into
   maximal repeats.

This is not a suffix tree: codes stand for words, and nothing is ordered or compared
beyond WINDOW words. With words in place of codes the shuffle would be ten times as large.

Tasks combine first: of the windows of one label each task sends on the earliest and
already knows the others to be repeats. A passage in a third of all documents
costs a group one row a task, not one a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubloom.llm.texts import (WordCodes, chunks, coded, mixed, runs, sequence_codes,
                               word_lists)

WINDOW, PREFIX = 20, 8
HALF = WINDOW // 2
#: Bytes of text to a group, most groups that windows are dealt to at once, and windows a
#: task holds before it sends.
GROUP_BYTES = 16 << 20
MOST_GROUPS = 1 << 15
HELD = 1_500_000
NO_ID = -2 ** 63

LEAVES = ("part long, known boolean, ats binary, contents binary, docs binary, "
          "places binary, first binary, second binary")
#: Places of many documents, packed; then of one.
FOUND = "bucket int, ats binary, contents binary, docs binary, places binary"
PLACES = "at long, content long, places binary"

Arrow = Iterator[pa.RecordBatch]


def window_anchors(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start of each window, the place it picks, and the codes of all places."""
    codes = sequence_codes(flat, PREFIX, 2)
    choices = WINDOW - PREFIX + 1
    n = len(flat) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, codes
    least, pick = codes[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, choices):
        smaller = codes[j:j + n] < least
        np.copyto(least, codes[j:j + n], where=smaller)
        pick[smaller] = j
    whole = np.ones(n, bool)
    for end in starts[1:-1].tolist():
        whole[max(0, end - WINDOW + 1):end] = False
    windows = np.flatnonzero(whole)
    return windows, windows + pick[windows], codes


def packed_places(position: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """The documents of some ascending positions, places in each, and the places.

    Places are steps from one to the next, written byte plane by byte plane: steps are
    short, so all planes but one are nearly empty and shrink in a shuffle.
    """
    docs, counts = np.unique(position >> np.uint64(32), return_counts=True)
    steps = np.diff((position & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                    prepend=np.uint32(0))
    planes = np.ascontiguousarray(steps).view(np.uint8).reshape(-1, 4).T
    return docs.astype(np.int64), counts.astype(np.uint32).tobytes(), planes.tobytes()


def unpacked_places(counts: bytes, planes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Number of the document, among those packed, and place of each position."""
    many = np.frombuffer(counts, np.uint32)
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32)
    return (np.repeat(np.arange(len(many), dtype=np.uint32), many),
            np.cumsum(steps.ravel(), dtype=np.uint32))


class Leaves:
    """Windows a task has met: document, place and the two halves of the label."""

    def __init__(self, parts: int, all_alike: bool) -> None:
        """all_alike: the earliest of equal leaves counts as a repeat too."""
        self.parts, self.all_alike = parts, all_alike
        self.clear()

    def clear(self) -> None:
        self.held, self.n_docs = 0, 0
        self.ats, self.contents, self.docs = [], [], []
        self.places, self.first, self.second = [], [], []

    def add(self, ats, contents, docs, places, first, second) -> None:
        self.ats.append(ats), self.contents.append(contents)
        self.docs.append(docs.astype(np.uint32) + np.uint32(self.n_docs))
        self.places.append(places.astype(np.uint32))
        self.first.append(first), self.second.append(second)
        self.n_docs += len(ats)
        self.held += len(docs)

    def sorted(self) -> tuple[np.ndarray, ...]:
        """Documents in order, then the leaves by label and position."""
        ats, contents = np.concatenate(self.ats), np.concatenate(self.contents)
        docs, places = np.concatenate(self.docs), np.concatenate(self.places)
        first, second = np.concatenate(self.first), np.concatenate(self.second)
        self.clear()
        by = np.lexsort((contents, ats))
        ats, contents = ats[by], contents[by]
        new = np.ones(len(by), bool)
        new[1:] = (ats[1:] != ats[:-1]) | (contents[1:] != contents[:-1])
        rank = np.empty(len(by), np.uint64)
        rank[by] = np.cumsum(new) - 1
        position = rank[docs] << np.uint64(32) | places
        order = np.lexsort((position, second, first))
        return ats[new], contents[new], position[order], first[order], second[order]

    def judged(self) -> tuple[np.ndarray, ...]:
        """ats, contents, then of the leaves: position, label, is first, is repeat."""
        ats, contents, position, first, second = self.sorted()
        n = len(position)
        opens = np.ones(n, bool)
        opens[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        bounds = np.append(np.flatnonzero(opens), n)
        lengths = np.diff(bounds)
        least = np.repeat(position[bounds[:-1]], lengths)
        repeat = np.repeat(lengths > 1, lengths) if self.all_alike else position != least
        return ats, contents, position, first, second, opens, repeat

    def packed(self) -> Arrow:
        """One row for each part of the prefixes, and one of the known repeats."""
        if not self.held:
            return
        ats, contents, position, first, second, opens, repeat = self.judged()
        rows = []
        bits = self.parts.bit_length() - 1
        part = (first >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(
            len(first), np.int64)
        asked = np.flatnonzero(opens)  # in order of first, so of parts
        bounds = runs(part[asked])
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if lo < hi:
                at = asked[lo:hi]
                rows.append(self._row(int(part[at[0]]), False, ats, contents, position[at],
                                      first[at], second[at]))
        known = position[repeat]
        if len(known):
            spread = int(known.sum() % np.uint64(self.parts))
            rows.append(self._row(spread, True, ats, contents, known, first[:0], second[:0]))
        yield pa.RecordBatch.from_pylist(rows, schema=_LEAVES)

    @staticmethod
    def _row(part, known, ats, contents, position, first, second) -> dict:
        order = np.argsort(position)
        docs, counts, places = packed_places(position[order])
        if len(first):
            first, second = first[order], second[order]
        return {"part": part, "known": known, "ats": ats[docs].tobytes(),
                "contents": contents[docs].tobytes(), "docs": counts, "places": places,
                "first": first.tobytes(), "second": second.tobytes()}


_LEAVES = pa.schema([("part", pa.int64()), ("known", pa.bool_()),
                     *((n, pa.binary()) for n in ("ats", "contents", "docs", "places",
                                                  "first", "second"))])
_FOUND = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in (
    "ats", "contents", "docs", "places"))])
_PLACES = pa.schema([("at", pa.int64()), ("content", pa.int64()), ("places", pa.binary())])


class Places:
    """Places of documents, gathered to be sent on in few rows."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.held, self.n_docs = 0, 0
        self.ats, self.contents, self.docs, self.places = [], [], [], []

    def add(self, ats, contents, docs, places) -> None:
        self.ats.append(ats), self.contents.append(contents)
        self.docs.append(docs.astype(np.int64) + self.n_docs)
        self.places.append(places.astype(np.uint32))
        self.n_docs += len(ats)
        self.held += len(docs)

    def _joined(self) -> list[np.ndarray]:
        out = [np.concatenate(x) for x in (self.ats, self.contents, self.docs, self.places)]
        self.clear()
        return out

    def packed(self) -> Arrow:
        """One row for each bucket of documents."""
        if not self.held:
            return
        ats, contents, docs, places = self._joined()
        bucket = (mixed(ats.view(np.uint64) ^ contents.view(np.uint64))
                  % np.uint64(self.buckets)).astype(np.int64)[docs]
        position = docs.astype(np.uint64) << np.uint64(32) | places
        order = np.lexsort((position, bucket))
        bucket, position = bucket[order], position[order]
        bounds, rows = runs(bucket), []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            own, counts, steps = packed_places(position[lo:hi])
            rows.append({"bucket": int(bucket[lo]), "ats": ats[own].tobytes(),
                         "contents": contents[own].tobytes(), "docs": counts, "places": steps})
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    def by_document(self) -> Arrow:
        """One row for each document."""
        if not self.held:
            return
        ats, contents, docs, places = self._joined()
        order = np.lexsort((contents[docs], ats[docs]))
        ats, contents, places = ats[docs][order], contents[docs][order], places[order]
        new = np.ones(len(ats), bool)
        new[1:] = (ats[1:] != ats[:-1]) | (contents[1:] != contents[:-1])
        first = np.flatnonzero(new)
        rows = [x.tobytes() for x in np.split(places, first[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ats[first]), pa.array(contents[first]), pa.array(rows, pa.binary())],
            schema=_PLACES)


def _merged(batches: Arrow) -> Arrow:
    """One row for each document, from rows in order of their bucket."""
    held, now = Places(1), None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now:
                yield from held.by_document()
                now = row["bucket"]
            held.add(np.frombuffer(row["ats"], np.int64), np.frombuffer(row["contents"], np.int64),
                     *unpacked_places(row["docs"], row["places"]))
    yield from held.by_document()


def _ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("at").to_numpy(), part.column("content").to_numpy()


def _picked(parts: int) -> Callable[[Arrow], Arrow]:
    """Places that windows pick, labelled by the words there."""
    def run(batches: Arrow) -> Arrow:
        codes, leaves = WordCodes(), Leaves(parts, all_alike=True)
        for batch in batches:
            for part in chunks(batch):
                flat, starts = coded(word_lists(part.column("text").to_pylist()), codes)
                _, picks, labels = window_anchors(flat, starts)
                places = np.unique(picks)
                docs = np.searchsorted(starts, places, side="right") - 1
                leaves.add(*_ids(part), docs, places - starts[docs], labels[places],
                           np.zeros(len(places), np.uint64))
                if leaves.held >= HELD:
                    yield from leaves.packed()
        yield from leaves.packed()
    return run


def _suffixes(parts: int) -> Callable[[Arrow], Arrow]:
    """Windows whose picked place is among the document's repeated ones."""
    def run(batches: Arrow) -> Arrow:
        codes, leaves = WordCodes(), Leaves(parts, all_alike=False)
        for batch in batches:
            for part in chunks(batch):
                flat, starts = coded(word_lists(part.column("text").to_pylist()), codes)
                windows, picks, _ = window_anchors(flat, starts)
                repeated = np.zeros(len(flat) + 1, bool)
                for start, places in zip(starts.tolist(), part.column("places").to_pylist(),
                                         strict=False):
                    repeated[np.frombuffer(places, np.uint32).astype(np.int64) + start] = True
                at = windows[repeated[picks]]
                halves = sequence_codes(flat, HALF, 3)
                docs = np.searchsorted(starts, at, side="right") - 1
                leaves.add(*_ids(part), docs, at - starts[docs], halves[at], halves[at + HALF])
                if leaves.held >= HELD:
                    yield from leaves.packed()
        yield from leaves.packed()
    return run


def _unpacked(row: dict) -> list[np.ndarray]:
    return [np.frombuffer(row["ats"], np.int64), np.frombuffer(row["contents"], np.int64),
            *unpacked_places(row["docs"], row["places"]),
            np.frombuffer(row["first"], np.uint64), np.frombuffer(row["second"], np.uint64)]


def _dealt_on(parts: int, all_alike: bool) -> Callable[[Arrow], Arrow]:
    """Windows of groups, in order of these, by more bits; nothing is gathered but what
    a task holds before it sends."""
    def run(batches: Arrow) -> Arrow:
        leaves, now = Leaves(parts, all_alike), None
        for batch in batches:
            for row in batch.to_pylist():
                if row["known"]:
                    yield pa.RecordBatch.from_pylist([row], schema=_LEAVES)
                    continue
                if leaves.held >= HELD or row["part"] != now:
                    yield from leaves.packed()
                now = row["part"]
                leaves.add(*_unpacked(row))
        yield from leaves.packed()
    return run


def _repeats(parts: int, all_alike: bool) -> Callable[[Arrow], Arrow]:
    """Repeated windows by document, from rows in order of their part."""
    def subtree(rows: list[list[np.ndarray]], bit: int, found: Places) -> None:
        """More bits split what is too large to sort at once."""
        if sum(len(r[2]) for r in rows) > 4 * HELD and bit:
            for side in (0, 1):
                subtree([[r[0], r[1], *(x[(r[4] >> np.uint64(bit - 1)) & np.uint64(1) == side]
                                        for x in r[2:])] for r in rows], bit - 1, found)
            return
        leaves = Leaves(1, all_alike)
        for r in rows:
            leaves.add(*r)
        if leaves.held:
            ats, contents, position, _, _, _, repeat = leaves.judged()
            position = position[repeat]
            found.add(ats, contents, position >> np.uint64(32), position & np.uint64(0xFFFFFFFF))

    def run(batches: Arrow) -> Arrow:
        found = Places(min(parts, MOST_GROUPS))
        held, now = [], None
        for batch in batches:
            for row in batch.to_pylist():
                arrays = _unpacked(row)
                if row["known"]:
                    found.add(*arrays[:4])
                else:
                    if row["part"] != now and held:
                        subtree(held, 48, found)
                        held = []
                    now = row["part"]
                    held.append(arrays)
                if found.held >= HELD:
                    yield from found.packed()
        if held:
            subtree(held, 48, found)
        yield from found.packed()
    return run


def covered(n: int, places: bytes) -> np.ndarray:
    """Which of n words lie in the windows that start at these places."""
    starts = np.frombuffer(places, np.uint32).astype(np.int64)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def _kept(texts: bool) -> Callable[[Arrow], Arrow]:
    def run(batches: Arrow) -> Arrow:
        for batch in batches:
            for part in chunks(batch):
                counts, gone, digests, kept = [], [], [], []
                for words, places in zip(word_lists(part.column("text").to_pylist()),
                                         part.column("places").to_pylist(), strict=True):
                    counts.append(len(words))
                    if places:
                        words = list(compress(words, (~covered(len(words), places)).tolist()))
                    gone.append(counts[-1] - len(words))
                    left = b" ".join(words)
                    digests.append(hashlib.sha256(left).hexdigest())
                    if texts:
                        kept.append(left.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()),
                     pa.array(gone, pa.int64()), pa.array(digests, pa.string()),
                     *([pa.array(kept, pa.string())] if texts else [])],
                    ["doc_id", "n_words", "n_removed", "kept_sha256",
                     *(["kept_text"] if texts else [])])
    return run


def _parts(read: DataFrame) -> int:
    """Groups of windows: a power of two that follows the size of the corpus, and
    enough for every task of a shuffle."""
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = 1
    while parts * GROUP_BYTES < size or parts < min(least, MOST_GROUPS):
        parts *= 2
    return parts


def _tasks(rows: DataFrame, parts: int) -> int:
    """Tasks to deal groups to: some of the size of a group for each."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts // 16)


def _dealt(rows: DataFrame, by: str, parts: int) -> DataFrame:
    return rows.repartition(_tasks(rows, parts), by).sortWithinPartitions(by)


def _by_document(leaves: DataFrame, parts: int, all_alike: bool) -> DataFrame:
    """Places of repeats by document, from windows in their first groups."""
    done = min(parts, MOST_GROUPS)
    while done < parts:
        more = min(parts, done * MOST_GROUPS)
        leaves = _dealt(leaves, "part", done).mapInArrow(_dealt_on(more, all_alike), LEAVES)
        done = more
    found = _dealt(leaves, "part", parts).mapInArrow(_repeats(parts, all_alike), FOUND)
    return _dealt(found, "bucket", min(parts, MOST_GROUPS)).mapInArrow(_merged, PLACES)


def without_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text for each row of `docs`.

    Reads doc_id and text. kept_text, left out unless `texts`, is the words that
    stay, joined by one space; kept_sha256 is its digest.
    A null or empty text has no words. A null doc_id comes before all others. Rows
    of one doc_id are ordered by a hash of their texts; equal rows are one
    document and get equal results. An empty table gives an empty result.
    """
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("at"),
        F.xxhash64("text").alias("content"), F.col("text").cast("binary").alias("text"))
    parts = _parts(read)
    first = min(parts, MOST_GROUPS)
    picked = _by_document(read.mapInArrow(_picked(first), LEAVES), parts, True)
    near = read.join(picked, ["at", "content"])
    repeated = _by_document(near.mapInArrow(_suffixes(first), LEAVES), parts, False)
    rows = read.join(repeated, ["at", "content"], "left")
    return rows.mapInArrow(_kept(texts), "doc_id long, n_words long, n_removed long, "
                           "kept_sha256 string" + ", kept_text string" * texts)
