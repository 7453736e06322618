"""Near duplicates: banded MinHash, odd sketches, confirmation on whole sets.

A document's set holds its distinct 5-word shingles (words lower-cased in A-Z;
fewer words: the whole sequence as one; none: empty, linked with nothing).
Documents are linked when 100 * intersection >= 85 * union.

1. Equal sets are one class, by a digest of the set; only classes go on.
2. Each class has SAMPLES MinHash values. BANDS bands of ROWS values are bucket
   keys: a pair of similarity s shares no key with (1 - s^ROWS)^BANDS, 3e-7 at
   0.85 and less above.
3. The samples are folded into an odd sketch: every (place, value) flips one of
   SKETCH_BITS bits. The population count of two sketches' XOR estimates how many
   samples differ. A candidate goes on if its sizes allow the similarity and it has
   at most MOST_FLIPPED bits, over five deviations above what 0.85 gives.
4. First each bucket's members are compared with the member whose buckets hold most
   in all, which in a group of near copies is their common origin. Where members of
   a bucket then still lie in several components, these classes get sketches of
   FINE_SAMPLES samples in FINE_BITS bits, which tell similarities just below the
   threshold apart, and the bucket is compared in full, in cells of at most CELL x
   CELL rows, across components only, each pair in one bucket only. So every pair of
   a bucket is either compared or already connected.
5. Candidates are confirmed on their whole shingle sets.

Sets are held as 64-bit hashes of shingles. No bucket, group or list of
documents is gathered in one task or on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubloom.llm.components import components
from hubloom.llm.rows import Carried
from hubloom.llm.texts import (WordCodes, chunks, coded, mixed, odd_constants,
                               sequence_codes, word_lists)
from hubloom.session import keep

SHINGLE = 5
SAMPLES, BANDS, ROWS = 192, 32, 6
SKETCH_BITS = 512
MOST_FLIPPED = 100
FINE_SAMPLES, FINE_BITS, FINE_FLIPPED = 1024, 2048, 365
LEAST_PERCENT = 85
CELL = 1024

_XOR = odd_constants(5, FINE_SAMPLES, np.uint32)[:, None]
_FACTOR = odd_constants(6, FINE_SAMPLES, np.uint32)[:, None]
_PLACE = odd_constants(7, FINE_SAMPLES, np.uint32)
_BAND = odd_constants(8, ROWS)
_AT_ONCE = 2048

FEATURES = ("doc_id long, a long, b long, n_shingles long, class binary, "
            "sketch array<long>, keys array<long>")


def shingle_sets(texts: list[bytes | None], codes: dict) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    flat, starts = coded(word_lists(texts, lower=True), codes)
    whole = sequence_codes(flat, SHINGLE, 1)
    sets = []
    for start, stop in zip(starts[:-1], starts[1:], strict=True):
        n = int(stop - start)
        if n >= SHINGLE:
            sets.append(np.unique(whole[start:stop - SHINGLE + 1]))
        else:
            sets.append(sequence_codes(flat[start:stop], n, 1) if n else whole[:0])
    return sets


def minhash(shingles: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """n minima over a set that is not empty."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    at_once = _AT_ONCE * SAMPLES // n
    for i in range(0, len(low), at_once):
        scrambled = low[i:i + at_once] ^ _XOR[:n]
        scrambled *= _FACTOR[:n]
        np.minimum(least, scrambled.min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity of the bits that (place, value) pairs fall on, as longs."""
    x = (samples ^ _PLACE[:len(samples)]) * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0xC2B2AE35)
    x >>= np.uint32(33 - bits.bit_length())
    return np.packbits(np.bincount(x, minlength=bits).astype(np.uint8) & 1).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    bands = samples.astype(np.uint64).reshape(BANDS, ROWS)
    summed = (mixed(bands + np.uint64(0x9E3779B97F4A7C15)) * _BAND).sum(axis=1, dtype=np.uint64)
    return mixed(summed + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = WordCodes()
    for batch in batches:
        for part in chunks(batch):
            counts, classes, sketches, keys = [], [], [], []
            for shingles in shingle_sets(part.column("text").to_pylist(), codes):
                counts.append(len(shingles))
                if not len(shingles):
                    classes.append(None), sketches.append(None), keys.append(None)
                    continue
                samples = minhash(shingles)
                classes.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sketches.append(odd_sketch(samples))
                keys.append(band_keys(samples))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "a", "b")), pa.array(counts, pa.int64()),
                 pa.array(classes, pa.binary()), pa.array(sketches, pa.list_(pa.int64())),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "a", "b", "n_shingles", "class", "sketch", "keys"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked pairs among (u, v, u_text, v_text); equal neighbours are read once."""
    codes = WordCodes()
    last_text, last_set = None, None
    for batch in batches:
        kept = []
        columns = (batch.column("u_text").to_pylist(), batch.column("v_text").to_pylist())
        for i, (u_text, v_text) in enumerate(zip(*columns, strict=True)):
            if v_text != last_text:
                last_text, last_set = v_text, shingle_sets([v_text], codes)[0]
            other = shingle_sets([u_text], codes)[0]
            shared = len(np.intersect1d(other, last_set, assume_unique=True))
            kept.append(100 * shared >= LEAST_PERCENT * (len(other) + len(last_set) - shared))
        yield pa.RecordBatch.from_arrays(
            [batch.column("u").filter(pa.array(kept)), batch.column("v").filter(pa.array(kept))],
            ["u", "v"])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = WordCodes()
    for batch in batches:
        for part in chunks(batch):
            sketches = [odd_sketch(minhash(x, FINE_SAMPLES), FINE_BITS)
                        for x in shingle_sets(part.column("text").to_pylist(), codes)]
            yield pa.RecordBatch.from_arrays(
                [part.column("class"), pa.array(sketches, pa.list_(pa.int64()))],
                ["class", "fine"])


def _flipped(one: str, other: str, bits: int) -> Column:
    return sum((F.bit_count(F.col(one)[i].bitwiseXOR(F.col(other)[i]))
                for i in range(bits // 64)), F.lit(0))


def _sizes_allow(one: str, other: str) -> Column:
    return 100 * F.least(one, other) >= LEAST_PERCENT * F.greatest(one, other)


def _class_texts(read: DataFrame, known: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each wanted class, found by its row's id and content hashes."""
    at = F.struct("a", "b", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("at"))
    # Copies are combined before they are dealt out; a semi-join would go below that.
    holders = (known.groupBy("class").agg(F.min(at).alias("row")).join(wanted, "class")
               .select("class", "row.*"))
    rows = read.withColumn("at", F.coalesce("doc_id", F.lit(-2 ** 63)))
    return (rows.join(holders, ["a", "b", "at"]).select("class", "text")
            .dropDuplicates(["class"]))


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are linked, by their classes' texts."""
    u = texts.select(F.col("class").alias("u"), F.col("text").alias("u_text"))
    v = texts.select(F.col("class").alias("v"), F.col("text").alias("v_text"))
    rows = pairs.join(u, "u").join(v, "v").select("u", "v", "u_text", "v_text")
    return rows.mapInArrow(_confirm, "u binary, v binary")


def _as(rows: DataFrame, side: str, columns: list[str]) -> DataFrame:
    """A class's columns, named for one side of a pair."""
    return rows.select(F.col("class").alias(side), *(F.col(c).alias(f"{side}_{c}")
                                                     for c in columns))


def _star_pairs(members: DataFrame, known: DataFrame) -> DataFrame:
    """Each bucket's members with its centre, where sizes and sketches are close."""
    spark = members.sparkSession
    scores = members.groupBy("class").agg(F.sum("n").alias("score"))
    scored = keep(spark, members.select("key", "class").join(scores, "class"), "scored")
    # Written, so that the join back does not share its shuffle with the aggregate and a
    # bucket of many copies can be split.
    centre = keep(spark, scored.groupBy("key").agg(F.max(F.struct("score", "class")).alias(
        "top")).select("key", F.col("top.class").alias("v")), "centres")
    pairs = (scored.join(centre, "key").where("class != v")
             .select(F.col("class").alias("u"), "v").distinct())
    columns = ["sketch", "n_shingles"]
    met = pairs.join(_as(known, "u", columns), "u").join(_as(known, "v", columns), "v")
    return met.where(_sizes_allow("u_n_shingles", "v_n_shingles")
                     & (_flipped("u_sketch", "v_sketch", SKETCH_BITS) <= MOST_FLIPPED)
                     ).select("u", "v")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return (rows.join(roots.withColumnRenamed("node", "class"), "class", "left")
            .withColumn("root", F.coalesce("root", "class")))


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, and into how many cells."""
    rooted = _rooted(members, roots)
    split = (rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
             .where("a != b").select("key"))
    return rooted.join(split, "key").withColumn("cells", F.ceil(F.col("n") / CELL).cast("int"))


def _cross_pairs(unsettled: DataFrame, known: DataFrame, fine: DataFrame) -> DataFrame:
    """Close pairs of a bucket that lie in different components so far."""
    rows = (unsettled.join(known.select("class", "n_shingles", "keys"), "class")
            .join(fine, "class")
            .withColumn("cell", F.pmod(F.xxhash64("class"), F.col("cells")).cast("int")))
    columns = ["root", "n_shingles", "keys", "fine", "key", "cell", "cells"]
    one = (_as(rows, "u", columns).withColumn("i", F.col("u_cell"))
           .withColumn("j", F.explode(F.sequence("u_cell", F.col("u_cells") - 1))))
    other = (_as(rows, "v", columns).withColumn("j", F.col("v_cell"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), "v_cell"))))
    met = one.join(other, (F.col("u_key") == F.col("v_key")) & (one.i == other.i)
                   & (one.j == other.j) & (F.col("u_root") != F.col("v_root"))
                   & ((one.i < one.j) | (F.col("u") > F.col("v")))
                   & _sizes_allow("u_n_shingles", "v_n_shingles")
                   & (_flipped("u_fine", "v_fine", FINE_BITS) <= FINE_FLIPPED)
                   & (F.array_min(F.array_intersect("u_keys", "v_keys")) == F.col("u_key")))
    return met.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _text_hashes(a: str = "a", b: str = "b") -> list[Column]:
    return [F.xxhash64("text").alias(a), F.xxhash64(F.lit(7), "text").alias(b)]


def _with_components(docs: DataFrame) -> DataFrame:
    """doc_id, a, b, n_shingles, class, root, component_id for each row of `docs`.

    a and b are hashes of the text. root names the component; it is null, as are
    class and component_id, for a row without words.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"), *_text_hashes())
    features = keep(spark, read.mapInArrow(_features, FEATURES), "features")
    known = features.where("class is not null")
    # What a class has follows from its set, so any of its rows will do.
    classes = known.groupBy("class").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
    keyed = classes.select("class", F.explode("keys").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = keep(spark, keyed.join(crowded, "key"), "members")
    met = members.select("class").distinct()
    near = keep(spark, classes.drop("least").join(met, "class"), "classes")
    texts = keep(spark, _class_texts(read, known, met), "texts")

    links = keep(spark, _linked(_star_pairs(members, near), texts), "links")
    unsettled = keep(spark, _unsettled(members, components(links)), "unsettled")
    fine = keep(spark, texts.join(unsettled.select("class").distinct(), "class", "left_semi")
                .mapInArrow(_finer, "class binary, fine array<long>"), "sketches")
    more = keep(spark, _linked(_cross_pairs(unsettled, near, fine), texts), "more-links")
    roots = components(links.unionAll(more))

    found = _rooted(classes.select("class", "least"), roots)
    smallest = found.groupBy("root").agg(F.min("least").alias("component_id"))
    # Written, so that the join to all documents can split a class of many copies.
    of_class = keep(spark, found.join(smallest, "root").select("class", "root", "component_id"),
                    "components")
    return (features.select("doc_id", "a", "b", "n_shingles", "class")
            .join(of_class, "class", "left"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id for each row of `docs`.

    component_id is the least doc_id reachable over links, itself included; kept
    marks the document that has it. Reads doc_id and text, whatever else there
    is. A null text has no words. Rows with one doc_id are one document only if
    their sets are equal; a null doc_id is linked like any other, but is never a
    component_id, and its `kept` is null. An empty table gives an empty result.
    """
    out = _with_components(docs)
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id") == component).alias("kept"),
                      F.lower(F.hex("class")).alias("class_id"))


def _unordered(kind: T.DataType) -> bool:
    """Whether values of a type, or what they hold, can't be put in order."""
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, as they are: one of each component.

    It is the row with the least doc_id (nulls last), then the least text hashes, then
    the least other columns, in their order; of rows equal in all, one. Maps and variants,
    which have no order, are compared as JSON. Rows without
    words are linked with nothing: those with one doc_id are one document, those with
    a null doc_id all stay.
    """
    spark = docs.sparkSession
    rows = _with_components(docs)
    group = F.coalesce(F.hex("root"), F.concat(F.lit("id "), F.col("doc_id").cast("string")),
                       F.concat_ws(" ", F.lit("text"), "a", "b"))
    unlinked = F.col("root").isNull() & F.col("doc_id").isNull()
    same = (rows.groupBy(group.alias("group"), "doc_id", "a", "b")
            .agg(F.count("*").alias("n"), F.first(unlinked).alias("unlinked")))
    first = same.groupBy("group").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "a", "b",
        F.when(F.col("unlinked"), 1).otherwise(F.col("n")).alias("n"))).alias("first"))
    staying = keep(spark, first.select(
        "first.a", "first.b", "first.no_id", F.coalesce("first.doc_id", F.lit(0)).alias("id"),
        "first.n"), "staying")
    place = ["a", "b", "no_id", "id"]
    carried = Carried(docs)
    a, b = _text_hashes()
    known = carried.rows(a=a, b=b, no_id=F.col("doc_id").isNull(),
                         id=F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    one = known.join(staying.where("n = 1").drop("n"), place, "left_semi").select(
        *carried.columns())
    several = staying.where("n > 1").drop("n")
    if several.isEmpty():
        return one
    # Copies are combined before they are dealt out, as far as a task has them.
    order = F.struct(*(F.to_json(F.struct(F.col("row")[c])) if _unordered(f.dataType) else
                       F.col("row")[c] for c, f in zip(carried.places, docs.schema, strict=True)))
    least = known.join(several, place, "left_semi").groupBy(*place).agg(
        F.min_by("row", order).alias("row"))
    return one.unionAll(least.select(*carried.columns()))
