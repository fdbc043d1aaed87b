"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of Hamming blocks, exact weighted-shingle similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, text_bytes, window_hashes, word_hashes, words

BITS = 64
# A block of items is broadcast while its texts stay within this size; a larger benchmark takes several blocks.
BLOCK_BYTES = 16 << 20

FOUND = pa.list_(pa.struct([("item", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("hamming", pa.int64()), ("similarity", pa.float64())]))
FOUND_DDL = "array<struct<item: long, start_word: long, n_words: long, hamming: long, similarity: double>>"


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle hash."""
    return (np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) << 1) - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from the sums of signs, one bit for each positive sum."""
    return np.packbits(sums > 0, axis=1).view(">u8").ravel().astype(np.uint64)


class Items:
    """Benchmark items of one block: shingles, fingerprints, and the multi-index by window size, block and value."""

    def __init__(self, texts: list[bytes], size: int, radius: int):
        memory = WordHashes()
        self.size, self.radius, self.blocks = size, radius, radius + 1
        self.cuts = np.linspace(0, BITS, self.blocks + 1).astype(int)
        self.n, self.counts, self.prints = [], [], np.zeros(len(texts), np.uint64)
        self.index: dict[tuple[int, int, int], list[int]] = {}
        owners: dict[int, list[int]] = {}
        self.short: dict[int, set[int]] = {}
        for i, text in enumerate(texts):
            tokens = word_hashes(words(text), memory)
            shingles = window_hashes(tokens, size)
            self.n.append(len(tokens))
            self.counts.append(dict(zip(*(x.tolist() for x in np.unique(shingles, return_counts=True)))))
            if not len(tokens):
                continue
            self.prints[i] = packed(signs(shingles).sum(axis=0, keepdims=True))[0]
            for b, value in enumerate(self.parts(int(self.prints[i]))):
                self.index.setdefault((len(tokens), b, value), []).append(i)
            for s in self.counts[i]:
                owners.setdefault(s, []).append(i)
            if len(tokens) < size:
                self.short.setdefault(len(tokens), set()).update(shingles.tolist())
        self.shingles = np.array(sorted(owners), np.uint64)
        # the items that own each shingle, one after the other, and their window sizes
        owned = [owners[s] for s in self.shingles.tolist()]
        self.owners = np.array([i for held in owned for i in held], np.int32)
        self.ends = np.cumsum([len(held) for held in owned], dtype=np.int64)
        self.sizes = [sorted({self.n[i] for i in held}) for held in owned]
        self.n_words = np.array(self.n, np.int64)
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(self.shingles >> np.uint64(48)).astype(np.int64)] = True

    def parts(self, value: int) -> list[int]:
        """The blocks of a fingerprint. Two within the radius agree in one at least, having more blocks than differences."""
        return [(value >> int(a)) & ((1 << int(b - a)) - 1) for a, b in zip(self.cuts, self.cuts[1:])]

    def near(self, value: int, n: int) -> Iterator[tuple[int, int]]:
        """Items of ``n`` words within the radius, and their distance."""
        met = set()
        for b, part in enumerate(self.parts(value)):
            met.update(self.index.get((n, b, part), ()))
        for i in sorted(met):
            d = (value ^ int(self.prints[i])).bit_count()
            if d <= self.radius:
                yield i, d

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item holds."""
        maybe = np.flatnonzero(self.bits[(shingles >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(self.shingles, shingles[maybe])
        at[at == len(self.shingles)] = 0
        return maybe[self.shingles[at] == shingles[maybe]]

    def sharing(self, at: np.ndarray, n: int, least: float) -> list[int]:
        """Items of ``n`` words that own ``least`` or more of the shingles ``at``, counted as often as they occur there."""
        first = np.where(at > 0, self.ends[at - 1], 0)
        many = self.ends[at] - first
        owners = self.owners[np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())]
        items, shared = np.unique(owners[self.n_words[owners] == n], return_counts=True)
        return items[shared >= least].tolist()

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        """Weighted Jaccard: each shingle weighs as often as it occurs."""
        own = self.counts[item]
        there = dict(zip(*(x.tolist() for x in np.unique(shingles, return_counts=True))))
        both = sum(min(c, there.get(s, 0)) for s, c in own.items())
        return both / (sum(own.values()) + len(shingles) - both)

    def search(self, text: bytes, memory: WordHashes, percent: int) -> list[dict]:
        """The best window for each item and place: overlapping windows of one item count as one find.

        A text shorter than the item is one window as a whole.

        A window without a shingle of any item has similarity 0 to all of them, so only windows that cover one are
        fingerprinted. Those with so many shingles of one item that they may be similar enough are compared with it whatever
        the distance of the fingerprints.
        """
        tokens = word_hashes(words(text), memory)
        if not len(tokens) or not len(self.shingles):
            return []
        jobs = [(size, window_hashes(tokens, size)) for size in sorted({self.size, *self.short}) if len(tokens) >= size]
        best: dict[int, list[dict]] = {}
        for width, shingles in jobs:
            hits = self.known(shingles)
            if not len(hits):
                continue
            places: dict[int, list[int]] = {}
            rank = np.searchsorted(self.shingles, shingles[hits])
            for p, at in zip(hits.tolist(), rank.tolist()):
                for n in self.sizes[at]:
                    if min(n, self.size) == width:
                        places.setdefault(n, []).append(p)
            for n, positions in places.items():
                own, span = n - width + 1, min(n, len(tokens)) - width + 1  # shingles of the item, and in a window
                if 100 * span < percent * own:
                    continue
                starts = np.unique(np.concatenate([np.arange(max(0, p - span + 1), min(p, len(shingles) - span) + 1) for p in positions]))
                # prefix sums of signs over the touched stretch give the sums of every window in it
                low, high = int(starts[0]), int(starts[-1]) + span
                sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(signs(shingles[low:high]), axis=0, dtype=np.int32)])
                prints = packed(sums[starts - low + span] - sums[starts - low])
                # similar enough takes so many shared shingles; no item can share more than the items of n words together
                least = percent * (own + span) / (100 + percent) - 1e-6
                shared = np.searchsorted(positions, starts + span) - np.searchsorted(positions, starts)
                for start, value, enough in zip(starts.tolist(), prints.tolist(), (shared >= least).tolist()):
                    candidates = dict(self.near(value, n))
                    if enough:
                        a, b = np.searchsorted(hits, (start, start + span))
                        candidates |= {i: (value ^ int(self.prints[i])).bit_count() for i in self.sharing(rank[a:b], n, least) if i not in candidates}
                    for item, distance in candidates.items():
                        similarity = self.similarity(item, shingles[start : start + span])
                        if 100 * similarity < percent - 1e-9:
                            continue
                        found = {"item": item, "start_word": start, "n_words": min(n, len(tokens)), "hamming": distance, "similarity": similarity}
                        last = best.setdefault(item, [])
                        if last and start < last[-1]["start_word"] + n:
                            if similarity > last[-1]["similarity"]:
                                last[-1] = found
                        else:
                            last.append(found)
        return [f for item in sorted(best) for f in best[item]]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """(item id, text) in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where(F.col(text_col).isNotNull()).toLocalIterator():
        block.append((row.i, row.t.encode()))
        size += len(block[-1][1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def finder(shared: Broadcast, percent: int) -> Callable[[Column], Column]:
    """A column function from text to its finds among the broadcast items."""

    @F.arrow_udf(FOUND_DDL)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory = WordHashes()
        for text in batches:
            yield pa.array([shared.value.search(t, memory, percent) for t in text_bytes(text)], type=FOUND)

    # counts as non-deterministic so that no filter inferred from its result evaluates it a second time
    return found.asNondeterministic()


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    size: int = 5, percent: int = 80, radius: int = 15,
) -> DataFrame:
    """Benchmark passages in documents: the id, item, start_word, n_words, hamming and similarity of each find.

    Windows of an item's number of words slide over every whole text; a shorter text is one window. A window within ``radius`` bits of the item's
    fingerprint is a candidate, found through ``radius`` + 1 blocks of which one must agree; so is one, whatever its distance,
    that shares enough shingles with the item. A candidate stays if the weighted Jaccard similarity of the ``size``-word
    shingles is ``percent`` hundredths or more. The radius loses nothing, and ``hamming`` may exceed it. Overlapping windows of an item give
    one find: the most similar, the first of equals. Shorter items are compared as one shingle.

    The benchmark is the stated query set: it is broadcast in blocks of bounded size, each against all documents. Null and
    empty texts and items match nothing. Repeated rows give repeated finds. Empty tables give no rows. Other columns are
    not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = benchmark.schema[item_col].dataType.simpleString()
    out = None
    for block in item_blocks(benchmark, item_col, item_text):
        shared = spark.sparkContext.broadcast(Items([t for _, t in block], size, radius))

        each = docs.select(F.col(id_col).alias("_doc"), F.explode(finder(shared, percent)(F.col(text_col))).alias("f"))
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"n long, _item {kind}")
        rows = each.join(names, F.col("f.item") == F.col("n")).select(F.col("_doc").alias(id_col), F.col("_item").alias(item_col), "f.start_word", "f.n_words", "f.hamming", "f.similarity")
        out = rows if out is None else out.union(rows)
    if out is None:
        none = docs.select(id_col).where("false")
        return none.select(
            id_col, F.lit(None).cast(kind).alias(item_col), *[F.lit(0).cast("long").alias(c) for c in ("start_word", "n_words", "hamming")], F.lit(0.0).alias("similarity")
        )
    return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 80, radius: int = 15, flag: str = "_contaminated"
) -> DataFrame:
    """The given rows with a boolean column ``flag``: whether the text holds a benchmark passage, as ``matches`` finds them."""
    bounded_batches(docs.sparkSession)
    out = docs.withColumn(flag, F.lit(False))
    for block in item_blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items([t for _, t in block], size, radius))
        out = out.withColumn(flag, F.col(flag) | (F.size(finder(shared, percent)(F.col(text_col))) > 0))
    return out
