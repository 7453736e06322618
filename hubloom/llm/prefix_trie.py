"""The trie of conversations that share heads, by composed fingerprints.

A rebuilt conversation is a head of its base conversation followed by its own turns from
some place on. Rebuilt texts are never made. A turn is known by its place and by 128
bits of a digest; a sequence of turns has a fingerprint of LANES sums of h_i * y^i
modulo a prime, h_i from the digest of turn i. With its length this is a monoid: the
sums of a concatenation are s1 + y^n1 * s2. So the fingerprint of every prefix of a
rebuilt conversation follows from prefix sums of the base and of its own turns.

1. Turns are range-sorted by conversation, turn and digest, so a conversation may lie in
   many tasks. Each task sums up its stretches; the few conversations that cross ranges
   are composed from their stretches.
2. One row for each conversation and depth names its fingerprint, that of the prefix one
   turn shorter, and its last turn. Rows with equal fingerprints are a node, which is
   named by its least member and its depth.
3. Equality is verified: turns of one digest are compared, text by text, with the turn
   that the first reference to it names; all rows of a node must have one parent and one
   last turn. A node that fails means two sequences met in all sums; then everything is
   done again with other numbers y.
4. Sums over subtrees double their reach: what lies within 2^k levels below a node is
   added to its ancestor 2^k levels up, which is looked up by member and depth. Rounds
   grow with the logarithm of the depth.
5. Lists of members are sorted over all tasks, written as stretches of digits and run
   through the digest stretch by stretch; no list is ever in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubloom.operators.skew import hot_keys, salted_join
from hubloom.session import keep

#: The modulus of a fingerprint's sums, their number, and the draws of y that are tried.
PRIME, LANES, DRAWS = (1 << 31) - 1, 4, 5

Arrow = Iterator[pa.RecordBatch]

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, last_conv_id long, "
         "last_position long")


def bases(draw: int) -> list[int]:
    """The numbers y of each lane, which follow from the draw."""
    return np.random.default_rng(1000 + draw).integers(2, PRIME - 1, LANES).tolist()


def powers(y: list[int], n: int) -> np.ndarray:
    """y^0 to y^(n - 1) of each lane."""
    out = np.ones((max(n, 1), LANES), np.int64)
    size = 1
    while size < n:
        step = np.array([pow(b, size, PRIME) for b in y], np.int64)
        out[size:2 * size] = out[:min(size, n - size)] * step % PRIME
        size *= 2
    return out


class Prefix:
    """Length and sums of a sequence of turns."""

    def __init__(self, y: list[int], n: int = 0, sums: list[int] | None = None) -> None:
        self.y, self.n = y, n
        self.sums = np.array(sums or [0] * LANES, np.int64)

    def factor(self) -> np.ndarray:
        return np.array([pow(b, self.n, PRIME) for b in self.y], np.int64)

    def then(self, sums: np.ndarray) -> np.ndarray:
        """The sums of this sequence followed by sequences with these sums."""
        return (self.sums + self.factor() * sums) % PRIME


def _scanned(y: list[int]) -> Callable[[Arrow], Arrow]:
    """Place and sums before and after each turn, within its conversation in this range."""
    def run(batches: Arrow) -> Arrow:
        conv, held = None, Prefix(y)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            convs = batch.column("conv_id").to_numpy()
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<i8")
            digests = digests.reshape(n, 4)
            terms = (digests.view(np.uint64) % np.uint64(PRIME)).astype(np.int64)
            first = np.concatenate(([0], np.flatnonzero(convs[1:] != convs[:-1]) + 1))
            start = np.repeat(first, np.diff(np.append(first, n)))
            place = np.arange(n) - start
            terms = terms * powers(y, n)[place] % PRIME
            total = np.concatenate((np.zeros((1, LANES), np.int64), np.cumsum(terms, axis=0)))
            before = (total[:-1] - total[start]) % PRIME
            after = (total[1:] - total[start]) % PRIME
            if conv == convs[0]:
                stop = first[1] if len(first) > 1 else n
                before[:stop], after[:stop] = held.then(before[:stop]), held.then(after[:stop])
                place[:stop] += held.n
            conv, held = convs[-1], Prefix(y, int(place[-1]) + 1, after[-1].tolist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "range", "role", "text")),
                 pa.array(place), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 pa.array(list(before), pa.list_(pa.int64())),
                 pa.array(list(after), pa.list_(pa.int64()))],
                ["conv_id", "range", "role", "text", "place", "k1", "k2", "before", "after"])
    return run


def _carried(y: list[int]) -> Callable[[Arrow], Arrow]:
    """For each later range of a conversation: length, sums and factor of what precedes."""
    def run(batches: Arrow) -> Arrow:
        for batch in batches:
            rows = []
            for conv, stretches in zip(batch.column("conv_id").to_pylist(),
                                       batch.column("stretches").to_pylist(), strict=True):
                held = Prefix(y)
                for s in stretches:
                    if held.n:
                        rows.append((conv, s["range"], held.n, held.sums.tolist(),
                                     held.factor().tolist()))
                    held = Prefix(y, held.n + s["n"], held.then(np.array(s["after"])).tolist())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
                    pa.list_(pa.int64())), strict=True)],
                ["conv_id", "range", "n", "sums", "factor"])
    return run


def _lanes(of: Callable[[int], Column]) -> Column:
    return F.array(*(of(i) for i in range(LANES)))


def _number(sums: Column, half: int) -> Column:
    """Two lanes as one number."""
    return F.shiftleft(sums[2 * half], 31).bitwiseOR(sums[2 * half + 1])


def _turns(rows: DataFrame, y: list[int]) -> DataFrame:
    """The turns with their places and the sums before and after them, as a table."""
    spark = rows.sparkSession
    order = ["conv_id", "turn", "digest"]
    ordered = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row")
    stretches = keep(spark, ordered.withColumn("range", F.spark_partition_id()).select(
        "conv_id", "range", "role", "text", "digest").mapInArrow(
        _scanned(y), "conv_id long, range int, role string, text string, place long, k1 long, "
        "k2 long, before array<long>, after array<long>"), "stretches")
    sums = stretches.groupBy("conv_id", "range").agg(
        (F.max("place") + 1).alias("n"), F.max_by("after", "place").alias("after"))
    carried = sums.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("range", "n", "after"))).alias("stretches")).where(
        F.size("stretches") > 1).mapInArrow(
        _carried(y), "conv_id long, range int, n long, sums array<long>, factor array<long>")

    def whole(name: str) -> Column:
        sums, factor, own = F.col("sums"), F.col("factor"), F.col(name)
        return F.when(sums.isNull(), own).otherwise(
            _lanes(lambda i: (sums[i] + factor[i] * own[i] % PRIME) % PRIME))
    return stretches.join(carried, ["conv_id", "range"], "left").select(
        "conv_id", "role", "text", (F.col("place") + F.coalesce("n", F.lit(0))).alias("place"),
        "k1", "k2", whole("before").alias("before"), whole("after").alias("after"),
        F.octet_length("text").cast("long").alias("bytes"))


def _verify_turns(turns: DataFrame) -> None:
    """Compare every turn with the first one of its digest, text by text."""
    key = ["k1", "k2"]
    counts = turns.groupBy(*key).agg(F.count("*").alias("n_rows"),
                                     F.min("conv_id").alias("conv_id"))
    counts = keep(turns.sparkSession, counts, "digests")
    shared = counts.where("n_rows > 1")
    # The least conversation may hold such a turn twice; the first place is the reference.
    first = turns.select(*key, "conv_id", "place").join(shared, [*key, "conv_id"]).groupBy(
        *key, "conv_id").agg(F.min("place").alias("place"))
    named = turns.select("conv_id", "place", F.col("role").alias("named_role"),
                         F.col("text").alias("named_text")).join(
        first, ["conv_id", "place"]).select(*key, "named_role", "named_text")
    met = salted_join(turns.select("conv_id", "place", "role", "text", *key), named, key,
                      spread_by=["conv_id", "place"], hot=hot_keys(counts, key))
    if not met.where("role != named_role or text != named_text").isEmpty():
        raise ValueError("two different turns share 128 bits of their SHA-256")


def _members(turns: DataFrame, base: Column, head: Column, most_head: int,
             y: list[int]) -> tuple[DataFrame, DataFrame]:
    """All prefixes but the empty one of each rebuilt conversation, and their lengths."""
    spark = turns.sparkSession
    zero = F.array(*[F.lit(0).cast("long")] * LANES)
    firsts = F.array_sort(F.collect_list(F.when(F.col("place") < most_head, F.struct(
        "place", "after", "k1", "k2", "bytes"))))
    convs = keep(spark, turns.groupBy("conv_id").agg(
        (F.max("place") + 1).alias("n"), firsts.alias("firsts")), "conversations")
    cut = F.least(F.greatest(F.coalesce(head, F.lit(0)), F.lit(0)), F.lit(most_head)).cast("int")
    heads = convs.select("conv_id", "n", "firsts", base.cast("long").alias("base"),
                         cut.alias("cut"))
    heads = heads.join(convs.select(F.col("conv_id").alias("base"), F.col("firsts").alias("given")),
                       "base", "left")
    given = F.slice(F.coalesce("given", F.slice("firsts", 1, 0)), F.lit(1), F.col("cut"))
    heads = heads.withColumn("given", given).withColumn("n_given", F.size("given"))
    last = lambda rows, n: F.coalesce(F.get(rows, n - 1)["after"], zero)
    heads = heads.withColumns({
        "from": last(F.col("given"), F.col("n_given")),
        "left": last(F.col("firsts"), F.least(F.col("cut"), F.col("n")).cast("int")),
        "length": F.col("n_given") + F.greatest(F.col("n") - F.col("cut"), F.lit(0))})
    heads = keep(spark, heads, "heads")

    given = heads.select("conv_id", "base", "given", F.posexplode("given").alias("i", "t"))
    given = given.select(
        "conv_id", (F.col("i") + 1).cast("long").alias("depth"), F.col("t.after").alias("at"),
        F.coalesce(F.get("given", F.col("i") - 1)["after"], zero).alias("above"),
        "t.k1", "t.k2", "t.bytes", F.col("base").alias("last_conv_id"),
        F.col("t.place").alias("last_position"))
    # A suffix keeps its distance from the head, so its powers of y are shifted down.
    steps = [[pow(pow(b, -1, PRIME), k, PRIME) for k in range(most_head + 1)] for b in y]
    shift = [F.element_at(F.array(*map(F.lit, s)), F.col("cut") - F.col("n_given") + 1)
             for s in steps]
    moved = lambda sums: _lanes(lambda i: (
        F.col("from")[i] + (F.col(sums)[i] - F.col("left")[i] + PRIME) % PRIME
        * shift[i] % PRIME) % PRIME)
    own = turns.select("conv_id", "place", "before", "after", "k1", "k2", "bytes").join(
        heads.select("conv_id", "cut", "n_given", "from", "left"), "conv_id").where(
        F.col("place") >= F.col("cut"))
    own = own.select(
        "conv_id", (F.col("place") - F.col("cut") + F.col("n_given") + 1).alias("depth"),
        moved("after").alias("at"), moved("before").alias("above"), "k1", "k2", "bytes",
        F.col("conv_id").alias("last_conv_id"), F.col("place").alias("last_position"))
    rows = given.unionByName(own)
    rows = rows.select(
        "conv_id", "depth", _number(F.col("at"), 0).alias("f1"),
        _number(F.col("at"), 1).alias("f2"), _number(F.col("above"), 0).alias("p1"),
        _number(F.col("above"), 1).alias("p2"), "k1", "k2", "bytes", "last_conv_id",
        "last_position")
    return keep(spark, rows, "prefixes"), heads.select("conv_id", "length")


def _nodes(members: DataFrame) -> DataFrame | None:
    """Members with the least member of their node; None if a node is no single sequence."""
    key, one = ["depth", "f1", "f2"], ["p1", "p2", "k1", "k2"]
    nodes = keep(members.sparkSession, members.groupBy(*key).agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_rows"),
        *(f(c).alias(f"{n}_{c}") for c in one for n, f in (("least", F.min), ("most", F.max)))),
        "nodes")
    differ = " or ".join(f"least_{c} != most_{c}" for c in one)
    if not nodes.where(differ).isEmpty():
        return None
    nodes = nodes.select(*key, "owner", F.col("n_rows").alias("n_convs"), "n_rows")
    met = salted_join(members, nodes.drop("n_rows"), key, spread_by=["conv_id"],
                      hot=hot_keys(nodes, key))
    return keep(members.sparkSession, met.select(
        "conv_id", "depth", "owner", "n_convs", "bytes", "last_conv_id", "last_position"),
        "owners")


def _subtrees(nodes: DataFrame, owners: DataFrame, deepest: int) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens: sums over what lies below, itself included."""
    spark = nodes.sparkSession
    key, sums = ["conv_id", "depth"], ["n_leaves", "saved_tokens"]
    at = owners.select("conv_id", F.col("depth").alias("up"), "owner")
    live = nodes.select(*key, *sums)
    parts, step = [live], 1
    while step < deepest:
        up = F.col("depth") - step
        found = live.where(up > 0).withColumn("up", up).join(at, ["conv_id", "up"])
        found = keep(spark, found.groupBy(F.col("owner").alias("conv_id"), F.col("up").alias(
            "depth")).agg(*(F.sum(c).alias(c) for c in sums)), "subtrees")
        parts.append(found)
        step *= 2
        more = found.select(*key, *(F.col(c).alias(f"more_{c}") for c in sums))
        live = keep(spark, live.where(F.col("depth") > step).join(more, key, "left").select(
            *key, *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in sums)),
            "reach")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*key).agg(*(F.sum(c).alias(c) for c in sums))


def _stretches_of_digits(batches: Arrow) -> Arrow:
    """The members of each node in a batch, joined by commas."""
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("owner", "depth", "conv_id")]
        owner, depth, members = columns
        if not len(owner):
            continue
        cuts = np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1
        starts = np.concatenate(([0], cuts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[starts]), pa.array(depth[starts]), pa.array(members[starts]),
             pa.array([",".join(map(str, part.tolist())).encode()
                       for part in np.split(members, cuts)], pa.binary())],
            ["owner", "depth", "first", "digits"])


def _digests(batches: Arrow) -> Arrow:
    """One digest for each node, from its stretches in order."""
    def done(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.int64(), pa.int64(), pa.string()), strict=True)],
            ["conv_id", "depth", "ends_sha256"])
    node, digest = None, None
    for batch in batches:
        rows = []
        for owner, depth, digits in zip(*(batch.column(c).to_pylist() for c in (
                "owner", "depth", "digits")), strict=True):
            if (owner, depth) != node:
                if node:
                    rows.append((*node, digest.hexdigest()))
                node, digest = (owner, depth), hashlib.sha256(digits)
            else:
                digest.update(b"," + digits)
        if rows:
            yield done(rows)
    if node:
        yield done([(*node, digest.hexdigest())])


def _ends(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of nodes at which conversations end."""
    order = ["owner", "depth", "conv_id"]
    return ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _stretches_of_digits, "owner long, depth long, first long, digits binary").repartition(
        "owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(
        _digests, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, base: Column, head: Column, most_head: int) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, as the columns of NODES.

    A conversation is rebuilt as the first `head` turns of the conversation `base` (all
    if fewer, none if there is no such conversation), followed by its own turns after its
    first `head`. Both are functions of conv_id; `head` is held to 0 to `most_head`. A node
    is a sequence of turns, by role and text, that some rebuilt conversation starts with;
    its members are all that do, its conv_id is the least of them. n_leaves counts the
    childless nodes of its subtree, itself included; saved_tokens sums up over it what
    members but one of a node cost, in UTF-8 bytes of its last text; ends_sha256 is of the
    members with no further turns, ascending and joined by commas. last_conv_id and
    last_position (from 0) say where its last turn is stored; both are null at the root.

    A null role or text is empty. Turns of a conversation are in the order of `turn`, nulls
    first, and those of one `turn` in that of their digest, the SHA-256 of role length in
    bytes, a colon, role and text; equal rows are turns each. Rows with a null conv_id
    belong to no conversation and take no part. Other columns take no part. Without
    conversations there is no node, not even the root.
    """
    spark = conversations.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        text("role").alias("role"), text("text").alias("text")).where("conv_id is not null")
    rows = rows.withColumns({
        "digest": F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"),
                                          "role", "text"), 256)),
        "row": F.monotonically_increasing_id()})
    owners = None
    for draw in range(DRAWS):
        y = bases(draw)
        turns = _turns(rows, y)
        if not draw:
            _verify_turns(turns)
        members, lengths = _members(turns.drop("role", "text"), base, head, most_head, y)
        owners = _nodes(members)
        if owners is not None:
            break
    if owners is None:
        raise ValueError("fingerprints met in every draw")
    n_convs, root = lengths.agg(F.count("*"), F.min("conv_id")).first()
    if not n_convs:
        return spark.createDataFrame([], NODES)

    key = ["conv_id", "depth"]
    above = owners.select("conv_id", (F.col("depth") + 1).alias("depth"),
                          F.col("owner").alias("parent_conv_id"))
    nodes = owners.where("conv_id = owner").drop("owner").join(above, key, "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", F.lit(root)))
    nodes = keep(spark, nodes, "trie")
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (
        F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = keep(spark, nodes.join(children, key, "left").select(
        *key, "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"), "last_conv_id",
        "last_position"), "trie")
    deepest, n_first, n_leaves, saved = nodes.agg(
        F.max("depth"), F.count_if(F.col("depth") == 1), F.sum("n_leaves"),
        F.sum("saved_tokens")).first()
    sums = _subtrees(nodes, owners, deepest or 0)
    top = spark.range(1).select(
        F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n_convs).alias("n_convs"),
        F.lit(n_first).cast("long").alias("n_children"),
        F.lit(n_leaves if deepest else 1).cast("long").alias("n_leaves"),
        F.lit(saved or 0).cast("long").alias("saved_tokens"),
        F.lit(None).cast("long").alias("last_conv_id"),
        F.lit(None).cast("long").alias("last_position"))
    whole = nodes.drop("n_leaves", "saved_tokens").join(sums, key).unionByName(top)
    ends = lengths.select("conv_id", F.col("length").alias("depth")).join(
        owners.select(*key, "owner"), key, "left").withColumn(
        "owner", F.coalesce("owner", F.lit(root)))
    whole = whole.join(_ends(ends), key, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    return whole.select(*(c.split()[0] for c in NODES.split(", ")))
