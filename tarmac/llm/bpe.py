"""Byte-level BPE by ranks: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush, heapreplace
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

# Keys a bucket of the hash, pre-tokens taken from a text at a time, pre-tokens a worker remembers, and the longest of them.
BUCKET, CHUNK, REMEMBERED, LONGEST = 2, 100_000, 500_000, 64


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank, from lines of base64 and rank; ranks count from 0 without a gap."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must count from 0 without a gap")
    missing = 256 - sum(1 for t in tokens if len(t) == 1)
    if missing:
        raise ValueError(f"{missing} single bytes have no rank")
    return tokens


class PerfectHash:
    """Minimal perfect hash of distinct keys by displacement: n keys take the numbers 0 to n - 1, with one number a bucket.

    The largest buckets are placed first, each by the first seed that sends its keys to free places; a bucket of one key names its
    place outright (as a negative number).
    """

    def __init__(self, keys: list[bytes]):
        if len(set(keys)) != len(keys):
            raise ValueError("keys are not distinct")
        self.size, self.buckets = len(keys), max(1, len(keys) // BUCKET)
        self.seed, self.index = [0] * self.buckets, [-1] * len(keys)
        groups: dict[int, list[int]] = {}
        for i, key in enumerate(keys):
            groups.setdefault(xxhash.xxh3_64_intdigest(key) % self.buckets, []).append(i)
        order = sorted(groups.items(), key=lambda g: (-len(g[1]), g[0]))
        for bucket, group in (g for g in order if len(g[1]) > 1):
            for seed in count(1):
                places = {xxhash.xxh3_64_intdigest(keys[i], seed) % self.size for i in group}
                if len(places) == len(group) and all(self.index[p] < 0 for p in places):
                    break
            self.seed[bucket] = seed
            for i in group:
                self.index[xxhash.xxh3_64_intdigest(keys[i], seed) % self.size] = i
        free = (p for p in range(self.size) if self.index[p] < 0)
        for (bucket, group), place in zip([g for g in order if len(g[1]) == 1], list(free), strict=True):
            self.seed[bucket], self.index[place] = -1 - place, group[0]

    def lookup(self, key: bytes) -> int:
        """The index of the only key that ``key`` can be equal to; the caller compares."""
        seed = self.seed[xxhash.xxh3_64_intdigest(key) % self.buckets]
        return self.index[-1 - seed if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.size]


BEYOND = re.compile("[\U00010000-\U0010ffff]")
POINTS = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


@cache
def library_class(pattern: str) -> frozenset[str]:
    """All characters that the library takes for members of a class."""
    import tiktoken

    splitter = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    return frozenset("".join(bytes(splitter.encode_ordinary(POINTS[i : i + 65536])).decode() for i in range(0, len(POINTS), 65536)))


@cache
def other_classes() -> dict[int, str]:
    """Code points that ``regex`` takes for letters, numbers or white space and the library for something else, or the reverse.

    The two follow different versions of Unicode. Each is mapped to a character that both put into the class the library chooses, so that
    a text translated by this table is split by ``regex`` as the library would split it.
    """
    out: dict[int, str] = {}
    for pattern, typical in ((r"\p{L}", "\xe9"), (r"\p{N}", "\xb2"), (r"\s", " ")):
        theirs, ours = library_class(pattern), set(regex.findall(pattern, POINTS))
        out |= {ord(c): "" for c in ours - theirs if ord(c) not in out}
        out |= {ord(c): typical for c in theirs - ours}
    return out


@cache
def spelled_out(pattern: str, last: int) -> str | None:
    """The pattern for ``re``, its classes written as the library's own members up to a code point.

    ``re`` splits texts without later code points as the library does, and faster than ``regex``. None if the pattern has parts that
    the two may read differently.
    """
    spelled: dict[str, str] = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = sorted(ord(c) for c in library_class(name) if ord(c) <= last)
        starts = [c for before, c in zip([-2, *members], members) if c != before + 1]
        ends = [c for c, after in zip(members, [*members[1:], -2]) if after != c + 1]
        spelled[name] = "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(starts, ends))
    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\^?\w+\}|\\.|\(\?.|.", pattern, re.DOTALL):
        if part in spelled:
            part = spelled[part] if inside else f"[{spelled[part]}]"
        elif part == r"\S" and not inside:
            part = f"[^{spelled[r'\s']}]"
        elif part[0] == "\\":
            if len(part) > 2 or part[1].isalnum() and part[1] not in "nrtfv":
                return None
        elif inside:
            if part == "[":
                return None
            inside = part != "]"
        elif part in "^$" or part[:2] == "(?" and part[2] not in ":=!":
            return None
        else:
            inside = part == "["
        out.append(part)
    return "".join(out)


class Encoder(dict):
    """Encodes and decodes texts with one vocabulary.

    As a dictionary it remembers the ids of pre-tokens, packed as 32-bit numbers; when it has grown large it replaces ``older`` and starts anew.
    """

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.whole, self.classes = PerfectHash(tokens), other_classes()
        self.plain = [spelled_out(pattern, last) for last in (0x7F, 0xFFFF)]
        self.prepare()
        self.follow = self.joined()

    def __reduce__(self):
        return _encoder, ({k: self.__dict__[k] for k in ("tokens", "pattern", "plain", "whole", "classes", "follow")},)

    def prepare(self) -> None:
        self.split = regex.compile(self.pattern)
        self.ascii, self.basic = (re.compile(p) if p else None for p in self.plain)
        self.strange = frozenset(map(chr, self.classes))
        self.older: dict[str, bytes] = {}
        self.single = [self.rank(bytes([b])) for b in range(256)]

    def pieces(self, text: str) -> Iterator[str]:
        """Pre-tokens in order."""
        split = self.ascii if text.isascii() else self.basic if BEYOND.search(text) is None else None
        if split is None and (text.isascii() or self.strange.isdisjoint(set(text))):
            split = self.split
        if split is not None:
            return (m.group() for m in split.finditer(text)) if len(text) > CHUNK else iter(split.findall(text))
        return (text[m.start() : m.end()] for m in self.split.finditer(text.translate(self.classes)))

    def rank(self, word: bytes) -> int:
        """Rank of a word that is a token, else -1."""
        found = self.whole.lookup(word)
        return found if self.tokens[found] == word else -1

    def joined(self) -> list[dict[int, int]]:
        """For each token the tokens that may follow it and the rank of both joined; as large as the vocabulary allows.

        One more entry, without any, is that of the end mark -1 of ``merged``.
        """
        out: list[dict[int, int]] = [{} for _ in range(len(self.tokens) + 1)]
        for rank, token in enumerate(self.tokens):
            for cut in range(1, len(token)):
                if (left := self.rank(token[:cut])) >= 0 and (right := self.rank(token[cut:])) >= 0:
                    out[left][right] = rank
        return out

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word that is no token: the lowest rank is merged first, of equal ones the leftmost.

        The bytes are a linked list with an end mark of id -1 at place n. The heap holds (rank, place); an entry whose pair no longer has that
        rank is passed over. That of a merged pair makes room for the new pair at its place.
        """
        follow, n = self.follow, len(word)
        ids = [*map(self.single.__getitem__, word)]
        heap = [(rank, i) for i, (left, right) in enumerate(pairwise(ids)) if (rank := follow[left].get(right)) is not None]
        if not heap:
            return ids
        heapify(heap)
        ids.append(-1)
        after, before = [*range(1, n + 2)], [*range(-1, n)]
        while heap:
            rank, i = heap[0]
            j = after[i]
            if follow[ids[i]].get(ids[j]) != rank:
                heappop(heap)
                continue
            after[i] = k = after[j]
            before[k], ids[i], ids[j] = i, rank, -1
            found = follow[rank].get(ids[k])
            if found is not None:
                heapreplace(heap, (found, i))
            else:
                heappop(heap)
            h = before[i]
            found = follow[ids[h]].get(rank)
            if found is not None:
                heappush(heap, (found, h))
        return [t for t in ids if t >= 0]

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            word = piece.encode()
            rank = self.rank(word)
            packed = array("i", [rank] if rank >= 0 else self.merged(word)).tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                # what is still in use comes back from the older half one by one
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text of any length; its pre-tokens are taken ``CHUNK`` at a time."""
        pieces, parts = self.pieces(text), []
        while part := list(islice(pieces, CHUNK)):
            parts.append(b"".join(map(self.__getitem__, part)))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _encoder(state: dict) -> Encoder:
    out = Encoder.__new__(Encoder)
    out.__dict__ |= state
    out.prepare()
    return out


def encode(docs: DataFrame, encoder: Encoder, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``ids``, as the library that reads such rank files would encode the text as ordinary text.

    Each match of the pattern is encoded separately: one that is a token by a single look-up in the minimal perfect hash, any other by
    merging its bytes. Special tokens are not known; their strings are ordinary text.

    Null and empty texts have no ids. Ties between equal ranks go to the left. Repeated rows give repeated results, empty tables empty
    ones; other columns are not read. A text is read whole; a pre-token of n bytes takes n log n steps. The vocabulary is broadcast: its
    size is that of its file, whatever the documents.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(encoder)

    @F.arrow_udf("array<int>")
    def encoded(text: pa.Array) -> pa.Array:
        own = shared.value
        parts = [own.encode(t.as_py() or "") for t in text]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, np.concatenate([*parts, np.zeros(0, np.int32)]))

    return docs.select(F.col(id_col), encoded(F.col(text_col)).alias("ids"))


def decode(found: DataFrame, encoder: Encoder, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The same rows with the bytes behind the ids as another column (replacing one of that name); null ids give null.

    Any ids of the vocabulary are decoded, whether an encoder would give them or not; an id outside of it is an error.
    """
    shared = found.sparkSession.sparkContext.broadcast(encoder)

    @F.arrow_udf("binary")
    def decoded(ids: pa.Array) -> pa.Array:
        own = shared.value
        values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist()
        spans = zip(ends, ends[1:], ids.is_valid().to_pylist(), strict=False)
        return pa.array([own.decode(values[a:b].tolist()) if known else None for a, b, known in spans], type=pa.binary())

    return found.withColumn(out, decoded(F.col(ids_col)))


def digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)
