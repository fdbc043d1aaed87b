"""Prefix trie of rebuilt conversations from composable fingerprints; no rebuilt text is ever written.

A turn sequence has the fingerprint sum(t_j * r**j) modulo several primes, t_j from the digest of its j-th turn. Fingerprints of a head and of a
segment of another conversation compose: the segment is a difference of two prefix sums, shifted by a power of r. So every
prefix of every rebuilt conversation gets its fingerprint from numbers alone; equal ones are verified through the stored turns they refer to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

# The largest primes below 2**31. Products of two residues fit a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
# Rows of one conversation that one window orders, ids that one packed row holds, and tries with other bases after a collision.
SLICE, PACKED, TRIES = 1024, 4096, 3
SUMS = ("a", "b", "c", "d")


def bases(salt: int) -> list[int]:
    """A base for each prime; another salt gives others."""
    return [1_000_003 + 7_919 * m + 104_729 * salt for m in range(len(PRIMES))]


def power(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base ** exponent modulo the prime, by squaring."""
    out, square, left = np.ones(len(exponents), np.uint64), base % prime, exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * np.uint64(square) % np.uint64(prime)
        square, left = square * square % prime, left >> np.uint64(1)
    return out


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``conv`` stored in order, and where each stored part of a conversation begins.

    The rows are dealt by range of the whole order, so one conversation may lie in many tasks. ``pos`` names a row; its place in the conversation,
    from 1, is ``pos - first + before + 1`` for the part of its task.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(n, "conv", *order).sortWithinPartitions("conv", *order)
    stored = materialise(dealt.select("*", here.alias("pos"), F.shiftright(here, 33).alias("part")), "turns")
    parts = stored.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    earlier = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return stored, parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def prefix_sums(df: DataFrame, place: str, columns: list[str], descending: bool = False) -> DataFrame:
    """Running sums per ``conv`` along ``place``, this row included, ordered in slices; slice totals carry the sums on."""
    cut = df.withColumn("_slice", F.floor(F.col(place) / SLICE) * (-1 if descending else 1))
    inside = W.partitionBy("conv", "_slice").orderBy(F.desc(place) if descending else F.asc(place)).rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    inner = cut.withColumns({f"sum_{c}": F.sum(c).over(inside) for c in columns})
    # conversations of one slice need nothing carried
    totals = cut.groupBy("conv", "_slice").agg(*[F.sum(c).alias(c) for c in columns])
    carried = totals.select("conv", "_slice", *[F.sum(c).over(earlier).alias(f"_c_{c}") for c in columns])
    joined = inner.join(carried, ["conv", "_slice"])
    return joined.withColumns({f"sum_{c}": F.col(f"sum_{c}") + F.coalesce(f"_c_{c}", F.lit(0)) for c in columns}).drop("_slice", *[f"_c_{c}" for c in columns])


def term_udf(salt: int):
    """The summand of a turn at its place, one residue for each prime."""

    @F.arrow_udf(", ".join(f"{s} long" for s in SUMS))
    def terms(digest: pa.Array, place: pa.Array) -> pa.Array:
        parts = np.frombuffer(b"".join(digest.to_pylist()), ">u4").reshape(-1, 4).astype(np.uint64)
        at = place.to_numpy(zero_copy_only=False)
        out = []
        for m, (p, base) in enumerate(zip(PRIMES, bases(salt), strict=True)):
            out.append((parts[:, m] % np.uint64(p)) * power(base, at, p) % np.uint64(p))
        return pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=list(SUMS))

    return terms


def residue(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(PRIMES[m]))


def packed(residues: list[Column]) -> list[Column]:
    """Four residues as two longs."""
    return [F.shiftleft(residues[0], 31).bitwiseOR(residues[1]), F.shiftleft(residues[2], 31).bitwiseOR(residues[3])]


def members(places: DataFrame, offsets: DataFrame, salt: int, group: int, most: int) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, the empty prefix apart: depth, fingerprint, that of its parent, and the turn it ends with."""
    terms = places.withColumn("t", term_udf(salt)("digest", "i")).select("conv", "i", "pos", "bytes", "t.*")
    turns = prefix_sums(terms, "i", list(SUMS)).select(
        "conv", "i", "pos", "bytes", *SUMS, *[residue(F.col(f"sum_{s}"), m).alias(f"sum_{s}") for m, s in enumerate(SUMS)]
    )
    turns = materialise(turns, "sums")
    convs = offsets.groupBy("conv").agg(F.sum("n").alias("n"))
    convs = convs.withColumns({"h": F.crc32(F.col("conv").cast("string").cast("binary")) % most, "base": F.col("conv") - F.col("conv") % group})
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(sizes, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    at = lambda names, mark: turns.where(F.col("i") < most).select(
        F.col("conv").alias(names[0]), F.col("i").alias(names[1]), *[F.col(f"sum_{s}").alias(f"{mark}_{s}") for s in SUMS]
    )
    convs = convs.join(at(("base", "k"), "head"), ["base", "k"], "left").join(at(("conv", "h"), "own"), ["conv", "h"], "left")
    convs = convs.withColumns({f"{mark}_{s}": F.coalesce(f"{mark}_{s}", F.lit(0)) for mark in ("head", "own") for s in SUMS})
    convs = materialise(convs.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")

    # heads: at most ``most - 1`` turns, each shared by at most ``group`` conversations
    heads = convs.where("k > 0").select("conv", "base", "k", "length").join(turns.where(F.col("i") < most).withColumnRenamed("conv", "base"), "base").where("i <= k")
    full = [F.col(f"sum_{s}") for s in SUMS]
    heads = heads.select("conv", F.col("i").alias("depth"), "length", "pos", F.col("base").alias("turn_conv"), F.col("i").alias("turn_index"), "bytes",
                         *full, *[residue(F.col(f"sum_{s}") - F.col(s), m).alias(f"up_{s}") for m, s in enumerate(SUMS)])
    own = turns.join(convs, "conv").where("i > h")
    shifted = {}
    for m, (s, p, r) in enumerate(zip(SUMS, PRIMES, bases(salt), strict=True)):
        back = F.element_at(F.array(*[F.lit(pow(r, -e, p)) for e in range(most)]), (F.col("h") - F.col("k") + 1).cast("int"))
        value = residue(F.col(f"head_{s}") + residue(F.col(f"sum_{s}") - F.col(f"own_{s}"), m) * back % p, m)
        shifted |= {f"new_{s}": value, f"up_{s}": residue(value - F.col(s) * back % p, m)}
    own = own.withColumns(shifted).select("conv", (F.col("k") + F.col("i") - F.col("h")).alias("depth"), "length", "pos", F.col("conv").alias("turn_conv"),
                                          F.col("i").alias("turn_index"), "bytes", *[F.col(f"new_{s}").alias(f"sum_{s}") for s in SUMS], *[f"up_{s}" for s in SUMS])
    both = heads.unionByName(own)
    fx, fy = packed([F.col(f"sum_{s}") for s in SUMS])
    px, py = packed([F.col(f"up_{s}") for s in SUMS])
    empty = convs.where("length = 0").select("conv")
    rows = both.select("conv", "depth", "pos", "turn_conv", "turn_index", "bytes", (F.col("depth") == F.col("length")).alias("last"), fx.alias("fx"), fy.alias("fy"), px.alias("px"), py.alias("py"))
    none = empty.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(True).alias("last"), F.lit(0).cast("long").alias("fx"), F.lit(0).cast("long").alias("fy"))
    return rows.unionByName(none, allowMissingColumns=True)


def sound(kinds: DataFrame, nodes: DataFrame, stored: DataFrame) -> bool:
    """Whether equal fingerprints mean equal prefixes: one parent a node, and one role and text among the stored turns a node refers to."""
    if not nodes.where("px <> max_px OR py <> max_py").isEmpty():
        return False
    key = ["depth", "fx", "fy"]
    several = kinds.join(nodes.where("pos <> max_pos").select(*key), key).select(*key, "pos")
    said = several.join(stored.select("pos", "role", "text"), "pos").groupBy(*key, "role", "text").agg(F.count("*").alias("n"))
    return said.groupBy(*key).count().where("count > 1").isEmpty()


def subtree_totals(paths: DataFrame, columns: list[str]) -> DataFrame:
    """Sums over all descendants of each path of the path tree, itself included, by pointer doubling.

    After k rounds a row holds the sum over descendants nearer than 2**k, and ``up`` names the ancestor 2**k above; so there are as many rounds
    as the depth has binary digits, and each is two joins on the paths.
    """
    state = paths
    while not state.where("up IS NOT NULL").isEmpty():
        gain = state.where("up IS NOT NULL").groupBy(F.col("up").alias("conv")).agg(*[F.sum(c).alias(f"_g_{c}") for c in columns])
        above = state.where("up IS NOT NULL").select(F.col("conv").alias("up"), F.col("up").alias("_next"))
        grown = state.join(gain, "conv", "left").join(above, "up", "left")
        state = materialise(grown.select("conv", F.col("_next").alias("up"), *[(F.col(c) + F.coalesce(f"_g_{c}", F.lit(0))).alias(c) for c in columns]), "paths")
    return state


def packed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node_conv, depth, conv) rows as (node_conv, depth, first, ids): up to ``PACKED`` ids in one string."""
    key, ids = None, []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"node_conv": key[0], "depth": key[1], "first": ids[0], "ids": ",".join(map(str, ids))}], schema=PACK)

    for batch in batches:
        for node, depth, conv in zip(*[batch.column(c).to_pylist() for c in ("node_conv", "depth", "conv")], strict=True):
            if ids and ((node, depth) != key or len(ids) >= PACKED):
                yield row()
                ids = []
            key = (node, depth)
            ids.append(conv)
    if ids:
        yield row()


def joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node; sorted packed rows pass through one by one."""
    key, digest = None, hashlib.sha256()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"node_conv": key[0], "depth": key[1], "sha": digest.hexdigest()}], schema=SHA)

    for batch in batches:
        for node, depth, ids in zip(*[batch.column(c) for c in ("node_conv", "depth", "ids")], strict=True):
            now = (node.as_py(), depth.as_py())
            if key is not None and now != key:
                yield row()
                digest = hashlib.sha256()
            else:
                digest.update(b"," if key is not None else b"")
            key = now
            digest.update(ids.as_py().encode())
    if key is not None:
        yield row()


PACK = pa.schema([("node_conv", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
SHA = pa.schema([("node_conv", pa.int64()), ("depth", pa.int64()), ("sha", pa.string())])


def ends_of(ends: DataFrame, nodes: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node where more than one does.

    The ids are sorted by range over all tasks and packed there, thousands to a row, before a node's rows meet in one task; that task streams them.
    """
    key = ["depth", "fx", "fy"]
    several = nodes.where("n_ends > 1").select(*key, F.col("conv").alias("node_conv"))
    rows = ends.select(*key, "conv").join(several, key).select("node_conv", "depth", "conv")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["node_conv", "depth", "conv"]
    packs = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(packed_ids, "node_conv long, depth long, first long, ids string")
    dealt = packs.repartition("node_conv", "depth").sortWithinPartitions("node_conv", "depth", "first")
    return dealt.mapInArrow(joined_digests, "node_conv long, depth long, sha string").withColumnRenamed("node_conv", "conv")


def prefix_trie(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", group: int = 5, most: int = 9
) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations, with ``turn_conv`` and ``turn_index`` naming a stored turn each node ends with.

    Conversation c is rebuilt as the first h turns of conversation c - c % ``group``, then its own turns after its first h, with
    h = crc32(c) % ``most``. A node is a distinct sequence of turns that some rebuilt conversation starts with, from the empty one. It is named by
    ``conv_id``, its smallest member, and ``depth``: a member and a depth determine a prefix.

    Subtree sums use a decomposition into paths: the nodes of one ``conv_id`` are a path, and the paths form a tree, which is summed by pointer
    doubling. Nothing is gathered by conversation: turns are numbered, summed and carried in slices.

    Turns are ordered by number, null first, then role and text; repeated rows are turns of their own. Null roles and texts
    count as empty. Rows without a conversation id belong to no conversation. An empty table has no nodes. Other columns are not read, so their names cannot clash. A
    base conversation that does not occur gives no turns, and a conversation may be rebuilt to none at all; it is a member of the root only. Equal fingerprints are
    verified on the stored turns, and a collision starts a new try with other bases.
    """
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    said = rows.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).where("conv IS NOT NULL")
    stored, offsets = numbered(said, ["turn", "role", "text"])
    offsets = materialise(offsets, "offsets")
    key = ["depth", "fx", "fy"]
    for salt in range(TRIES):
        digest = F.unhex(F.md5(F.concat(F.lit(f"{salt}:"), F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
        parts = stored.select("conv", "part", "pos", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
        places = parts.join(offsets, ["conv", "part"]).withColumn("i", F.col("pos") - F.col("first") + F.col("before") + 1).select("conv", "i", "pos", "digest", "bytes")
        found = materialise(members(places, offsets, salt, group, most), "members")
        ended = F.when(F.col("last"), F.col("conv"))
        kinds = found.where("depth > 0").groupBy(*key, "px", "py", "pos", "turn_conv", "turn_index", "bytes").agg(
            F.min("conv").alias("conv"), F.count("*").alias("n"), F.count(ended).alias("n_ends"), F.min(ended).alias("end")
        )
        kinds = materialise(kinds, "kinds")
        same = lambda c: F.min(c).alias(c)
        nodes = kinds.groupBy(*key).agg(
            same("px"), same("py"), same("pos"), F.max("px").alias("max_px"), F.max("py").alias("max_py"), F.max("pos").alias("max_pos"), same("bytes"),
            same("conv"), F.sum("n").alias("n_convs"), F.sum("n_ends").alias("n_ends"), same("end"), F.min(F.struct("turn_conv", "turn_index")).alias("turn"),
        )
        nodes = materialise(nodes, "nodes")
        if sound(kinds, nodes, stored):
            break
    else:
        raise RuntimeError("fingerprints collide under all bases")
    empty = found.where("depth = 0").agg(F.count("*").alias("n_ends"), F.min("conv").alias("end"))
    whole = offsets.agg(F.min("conv").alias("conv"), F.countDistinct("conv").alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = whole.join(F.broadcast(empty), F.lit(True)).select(
        zero.alias("depth"), zero.alias("fx"), zero.alias("fy"), F.lit(None).cast("long").alias("parent"), "conv", "n_convs", "n_ends", "end", zero.alias("bytes"),
        F.lit(None).cast("long").alias("turn_conv"), F.lit(None).cast("long").alias("turn_index"),
    )
    first = root.select(F.col("conv").alias("parent"))
    plain = nodes.select(*key, "px", "py", "conv", "n_convs", "n_ends", "end", "bytes", "turn.turn_conv", "turn.turn_index")
    upper = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fx").alias("px"), F.col("fy").alias("py"), F.col("conv").alias("parent"))
    # all nodes of depth 1 have one parent: no shuffle by it
    below = plain.where("depth = 1").join(F.broadcast(first), F.lit(True)).unionByName(plain.where("depth > 1").join(upper, ["depth", "px", "py"]))
    tree = materialise(root.unionByName(below.drop("px", "py")), "tree")

    children = tree.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    valued = tree.join(children, ["conv", "depth"], "left").withColumns(
        {"n_children": F.coalesce("n_children", zero), "saved": (F.col("n_convs") - 1) * F.col("bytes"), "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")}
    )
    valued = materialise(valued, "valued")
    starts = valued.where("depth = 0 OR parent <> conv").select("conv", "parent", "depth")
    paths = valued.groupBy("conv").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    paths = paths.join(starts.select("conv", F.col("parent").alias("up")), "conv").select("conv", "up", "saved", "leaf")
    totals = subtree_totals(materialise(paths, "paths"), ["saved", "leaf"])
    hung = starts.where("depth > 0").join(totals.drop("up"), "conv").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth"))
    hung = hung.agg(F.sum("saved").alias("more_saved"), F.sum("leaf").alias("more_leaf"))
    own = valued.join(hung, ["conv", "depth"], "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", zero) for c in ("saved", "leaf")})
    summed = prefix_sums(own, "depth", ["saved", "leaf"], descending=True)
    digests = ends_of(found.where("last"), tree)
    out = summed.join(digests, ["conv", "depth"], "left")
    few = F.when(F.col("n_ends") == 0, F.lit("")).otherwise(F.col("end").cast("string"))
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("sum_leaf").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"), F.coalesce("sha", F.sha2(few.cast("binary"), 256)).alias("ends_sha256"), "turn_conv", "turn_index",
    )
