"""Near duplicates: bottom-k sketches of one hash function, inverted lists of the retained values, exact Jaccard on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, materialise, text_bytes, window_hashes, word_hashes, words

SKETCH = pa.struct([("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.list_(pa.int64()))])
SKETCH_DDL = "n_shingles long, set_key binary, sketch array<long>"

# Lists of so many open members are compared pair by pair, longer ones in blocks of at most so many rows and shingles.
PAIRWISE, BLOCK_ROWS, BLOCK_SHINGLES = 64, 1024, 1 << 21


def shingle_set(text: bytes, size: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct 63-bit values of the word shingles; a shorter text is one shingle, a text without words none."""
    found = window_hashes(word_hashes(words(text), memory), size)
    return np.unique(found >> np.uint64(1)).astype(np.int64)


def set_key(values: np.ndarray) -> bytes | None:
    """128 bits that name the set; none for the empty one."""
    import xxhash

    return xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, k: int) -> DataFrame:
    """doc_id, n_shingles, set_key and the ``k`` smallest values of every row's shingle set."""

    @F.arrow_udf(SKETCH_DDL)
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory = WordHashes()

        def one(text: bytes) -> dict:
            s = shingle_set(text, size, memory)
            return {"n_shingles": len(s), "set_key": set_key(s), "sketch": s[:k].copy()}

        for text in batches:
            yield pa.array([one(t) for t in text_bytes(text)], type=SKETCH)

    return docs.select(F.col(id_col).alias("doc_id"), sketched(F.col(text_col)).alias("s")).select("doc_id", "s.*")


def surely_shared(k: int, percent: int, miss: float = 1e-9) -> int:
    """How many of k sampled values two sets of this similarity share at least, but for a chance of ``miss``."""
    p, below = percent / 100, 0.0
    for need in range(k + 1):
        below += math.comb(k, need) * p**need * (1 - p) ** (k - need)
        if below > miss:
            return need
    return k


def inverted_lists(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, node) for the rarest retained values of each node, as many as two linked nodes need to meet.

    Two sets with a Jaccard of ``percent`` or more share at least ``need`` retained values: by counting if they lie within
    k, else but for a chance of 1e-9 a pair. If each node lists all but ``need`` - 1 of its values, rarest first, such a
    pair has a list in common.
    """
    n = F.least(F.col("n_shingles"), F.lit(k))
    need = F.greatest(F.least(F.ceil(F.col("n_shingles") * percent / 100), F.lit(surely_shared(k, percent))), F.lit(1))
    each = nodes.select("node", (n - need + 1).cast("int").alias("take"), n.cast("int").alias("n"), F.explode("sketch").alias("value"))
    common = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = each.join(common, "value").groupBy("node").agg(
        F.first("take").alias("take"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("rare")
    )
    # values that no other node retains come first in the order and need no list
    left = F.col("take") - (F.col("n") - F.size("rare"))
    listed = met.where(left > 0).select("node", F.explode(F.slice("rare", 1, left)).alias("r")).select("node", "r.value")
    several = listed.groupBy("value").agg(F.count("*").alias("m")).where("m > 1").select("value")
    return listed.join(several, "value").select("value", "node")


def estimate(a: str, b: str, k: int) -> Column:
    """Jaccard estimated from the union sketch: the share of its k smallest values that both sketches hold."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


def with_own(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, own, most): the set's size, its shingles that no other listed set has, and the largest partner it may link to.

    A partner shares at most n - own shingles with it, so its size is at most (n - own) * (1 + 100 / percent) - n.
    """
    single = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df"), F.min("node").alias("node")).where("df = 1")
    own = single.groupBy("node").agg(F.count("*").alias("own"))
    out = nodes.join(own, "node", "left").select("node", F.col("n_shingles").alias("n"), F.coalesce("own", F.lit(0)).alias("own"))
    return out.withColumn("most", F.expr(f"((n - own) * {100 + percent}) DIV {percent} - n"))


def still_open(members: DataFrame) -> DataFrame:
    """Members that may yet link, with the length and the mean set size of their list.

    They are in lists of several components that hold a small enough partner for them.
    """
    lists = members.groupBy("value").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("smallest"), F.count("*").alias("m"), F.avg("n").alias("mean")
    )
    left = members.join(lists.where("low < high"), "value").where("most >= smallest")
    return left.select("value", "node", "comp", "n", "own", "most", "m", "mean")


def hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """The hubs of each list against its members in other components, as far as their sizes allow a link.

    Each class of similar sizes has a hub, since no set links to one much larger. The member with the fewest shingles of
    its own is nearest to all others, so it makes the best hub.
    """
    part = F.floor(F.log("n") / math.log(100 / min(percent, 99)))
    hub = members.groupBy("value", part.alias("part")).agg(F.min(F.struct("own", "node", "comp", "n", "most")).alias("h"))
    hub = hub.select("value", F.col("h.node").alias("hub"), F.col("h.comp").alias("hub_comp"), F.col("h.n").alias("hub_n"), F.col("h.most").alias("hub_most"))
    met = members.join(hub, "value").where("comp != hub_comp AND n <= hub_most AND hub_n <= most")
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def all_pairs(members: DataFrame) -> DataFrame:
    """All pairs of different components in lists of bounded length, as far as their sizes allow a link."""
    few = members.where(F.col("m") <= PAIRWISE)
    other = few.select("value", F.col("node").alias("b"), F.col("comp").alias("comp_b"), F.col("n").alias("n_b"), F.col("most").alias("most_b"))
    met = few.join(other, "value").where("node < b AND comp != comp_b AND n <= most_b AND n_b <= most")
    return met.select(F.col("node").alias("a"), "b").distinct()


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in lists of any greater length, found without writing pairs: blocks of members meet in one task for each two.

    A task counts the shared shingles of all its pairs by products of incidence matrices and returns the links that join
    components.
    """
    rows = F.greatest(F.lit(16), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_SHINGLES) / F.col("mean"))))
    many = members.where(F.col("m") > PAIRWISE).withColumn("blocks", F.ceil(F.col("m") / rows).cast("int"))
    many = many.withColumn("own_block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(sets, "node")
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = many.select("value", "node", "comp", "n", "own_block", "shingles", meets.alias("other"))
    dealt = dealt.select("value", "node", "comp", "n", "own_block", "shingles", F.least("own_block", "other").alias("i"), F.greatest("own_block", "other").alias("j"))

    def linked(group: pa.Table) -> pa.Table:
        node, comp, n, block = (group[c].to_numpy() for c in ("node", "comp", "n", "own_block"))
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        shingles = group["shingles"].combine_chunks()
        value, at = np.unique(shingles.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(node)), n)
        shared = np.bincount(at, minlength=len(value)) > 1
        column = (np.cumsum(shared) - 1)[at]
        row, column = row[shared[at]], column[shared[at]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        both = np.zeros((len(left), len(right)), np.float32)
        place = np.zeros(len(node), np.int64)
        place[left], place[right] = np.arange(len(left)), np.arange(len(right))
        for low in range(0, int(shared.sum()), 2048):
            a, b = np.searchsorted(column, [low, low + 2048])
            matrices = []
            for side, k in ((left, i), (right, j)):
                mine = block[row[a:b]] == k
                m = np.zeros((len(side), 2048), np.float32)
                m[place[row[a:b][mine]], column[a:b][mine] - low] = 1
                matrices.append(m)
            both += matrices[0] @ matrices[1].T
        union = n[left][:, None] + n[right][None] - both
        name = {c: c for c in comp.tolist()}

        def find(x: int) -> int:
            while name[x] != x:
                name[x] = name[name[x]]
                x = name[x]
            return x

        out = []
        for x, y in np.argwhere((100 * both.astype(np.float64) >= percent * union) & (comp[left][:, None] != comp[right][None])).tolist():
            x, y = left[x], right[y]
            p, q = find(comp[x].item()), find(comp[y].item())
            if p != q:
                name[p] = q
                out.append({"a": node[x].item(), "b": node[y].item()})
        return pa.Table.from_pylist(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return dealt.groupBy("value", "i", "j").applyInArrow(linked, "a long, b long").distinct()


def confirmed(a: str, b: str, percent: int) -> Column:
    """Whether two stored full sets have a Jaccard similarity of ``percent`` hundredths or more."""

    @F.arrow_udf("boolean")
    def linked(a: pa.Array, b: pa.Array) -> pa.Array:
        sides = [(x.offsets.to_numpy(), x.values.to_numpy()) for x in (a, b)]
        out = []
        for i in range(len(a)):
            x, y = (values[at[i] : at[i + 1]] for at, values in sides)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    return linked(F.col(a), F.col(b))


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (node, comp) after joining the components of linked nodes; each takes the smallest name."""
    a = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    edges = materialise(links.join(a, "a").join(b, "b").where("ca != cb").select("ca", "cb").distinct(), "edges")
    if edges.isEmpty():
        return comps
    while not edges.isEmpty():
        ways = edges.unionByName(edges.select(F.col("cb").alias("ca"), F.col("ca").alias("cb")))
        up = ways.groupBy("ca").agg(F.min("cb").alias("up")).where("up < ca")
        # follow the pointers twice more, so that chains shrink quickly
        for _ in range(2):
            over = up.select(F.col("ca").alias("up"), F.col("up").alias("over"))
            up = up.join(over, "up", "left").select("ca", F.coalesce("over", "up").alias("up"))
        up = materialise(up, "parents")
        comps = comps.join(up.withColumnRenamed("ca", "comp"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
        for side in ("ca", "cb"):
            edges = edges.join(up.select(F.col("ca").alias(side), "up"), side, "left").withColumn(side, F.coalesce("up", side)).drop("up")
        edges = materialise(edges.where("ca != cb").distinct(), "edges")
    return materialise(comps, "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """One row per input row: the id, n_shingles, component_id (smallest id reachable over links) and kept.

    Texts are compared by their sets of ``size``-word shingles, A-Z lower-cased; a text with fewer words is one
    shingle. Sets with a Jaccard similarity of ``percent`` hundredths or more are linked. Rows with equal sets are one
    node, so copies cost nothing further. Candidates meet in inverted lists of retained values. First the hubs of every list
    meet its members; lists of which all members are then in one component are done, and so is a member whose own
    shingles, which nothing else has, rule out a link to any size in the list. What is left is compared pair by pair in
    lists of bounded length and in blocks in longer ones. So every pair of a list is compared, ruled out by counting, or
    already connected, and groups are not expanded into pairs. The union sketch discards pairs more than six
    standard errors below the threshold; the others are confirmed on full sets.

    Null and empty texts have no shingles, are linked with nothing, and have their own id as component_id. Repeated rows
    are in one component. Rows with a null id take part; their component_id is the smallest id of the component, null
    if it has none. Ties cannot occur, as sets and ids decide. Empty tables give empty ones; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = materialise(sketches(docs, id_col, text_col, size, k), "sketches")
    groups = rows.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    nodes = materialise(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")
    lists = materialise(inverted_lists(nodes, k, percent), "lists")
    comps = materialise(lists.select("node", F.col("node").alias("comp")).distinct(), "components")

    # full sets of the nodes that occur in lists, from their texts
    @F.arrow_udf("struct<key: binary, shingles: array<long>>")
    def full(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory = WordHashes()
        kind = pa.struct([("key", pa.binary()), ("shingles", pa.list_(pa.int64()))])
        for text in batches:
            sets = [shingle_set(t, size, memory) for t in text_bytes(text)]
            yield pa.array([{"key": set_key(s), "shingles": s} for s in sets], type=kind)

    # a filter inferred from the key would otherwise run it on all texts, before the join
    full = full.asNondeterministic()

    wanted = nodes.join(comps, "node", "left_semi").select("node", "set_key", F.col("first_id").alias("id"))
    ids = wanted.select(F.col("id").alias("wanted_id")).distinct()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
    source = source.select("id", full("t").alias("f")).select("f.key", "f.shingles")
    sets = source.join(wanted.select("node", F.col("set_key").alias("key")), "key").groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = materialise(sets, "sets")

    sized = with_own(nodes.select("node", "n_shingles").join(comps, "node", "left_semi"), sets, percent)
    sized = materialise(lists.join(sized, "node"), "sized")
    short = materialise(nodes.join(comps, "node", "left_semi").select("node", "sketch"), "short")

    bar = percent / 100 - 6 * (percent / 100 * (1 - percent / 100) / k) ** 0.5
    side = lambda df, name: df.select(F.col("node").alias(name), F.col(df.columns[1]).alias(f"{df.columns[1]}_{name}"))

    def links_of(pairs: DataFrame) -> DataFrame:
        near = pairs.join(side(short, "a"), "a").join(side(short, "b"), "b").where(estimate("sketch_a", "sketch_b", k) >= bar).select("a", "b")
        near = materialise(near, "candidates")
        return near.join(side(sets, "a"), "a").join(side(sets, "b"), "b").where(confirmed("shingles_a", "shingles_b", percent)).select("a", "b")

    members = materialise(still_open(sized.join(comps, "node")), "members")
    comps = merged(comps, materialise(links_of(hub_pairs(members, percent)), "links"))
    members = materialise(still_open(sized.join(comps, "node")), "members")
    links = links_of(all_pairs(members)).union(block_links(members, sets, percent))
    comps = merged(comps, materialise(links, "links"))

    # the component's smallest id, then back to the rows
    full_comps = nodes.select("node", "set_key", "first_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = full_comps.groupBy("comp").agg(F.min("first_id").alias("least"))
    named = full_comps.join(smallest, "comp").select("set_key", "least")
    out = rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least")))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
