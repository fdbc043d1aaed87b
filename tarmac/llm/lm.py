"""A hierarchical Pitman-Yor language model: context restaurants that share one parent, seated by Gibbs sampling."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MULTIPLIERS, bounded_batches, materialise, mix, text_bytes, words

BLOCK_TOKENS = 3_000_000
END = b""  # the end of a text, a word that no text holds


@dataclass(frozen=True)
class Settings:
    """Context words and classes, Gibbs sweeps, and the strength of all restaurants."""

    frequent: int = 512  # words whose classes are contexts; 0: a model without contexts
    classes: int = 16  # of those words; there is one more context for the start of a text
    rounds: int = 2
    burn: int = 10
    samples: int = 10
    strength: float = 1.0


def squeezed(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(arrays, protocol=5))


def opened(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


class Seats:
    """Chinese-restaurant seating of many dishes at once: the sizes of the tables that serve each dish.

    The form that moves single customers. The model needs the numbers of tables only and draws them whole (``Tables``).

    ``c`` customers and ``t`` tables per dish. A dish starts with about as many tables as sequential seating gives and is
    then moved by Gibbs steps, one customer of every dish at a time.
    """

    def __init__(self, customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator):
        self.c, self.d, self.rng = customers.astype(np.int64), discount, rng
        a = np.maximum(strength, 1e-12)
        t = np.clip(np.rint(a * np.log1p(self.c / a)).astype(np.int64), 1, np.maximum(self.c, 1))
        self.t = np.where(self.c > 0, t, 0)
        rank = np.arange(self.t.sum()) - np.repeat(np.cumsum(self.t) - self.t, self.t)
        # sizes fall as 1/rank, as those of sequential seating do on average
        weight = 1.0 / (rank + 1)
        dish = np.repeat(np.arange(len(self.t)), self.t)
        whole = np.bincount(dish, weight, len(self.t))
        size = 1 + np.floor((self.c - self.t)[dish] * weight / whole[dish]).astype(np.int64)
        rest = self.c - np.bincount(dish, size, len(self.t)).astype(np.int64)
        size[rank == 0] += rest[self.t > 0]
        self._lay(dish, size)

    def _lay(self, dish: np.ndarray, size: np.ndarray) -> None:
        """Room for more tables behind the present ones of each dish."""
        self.used = self.t.copy()
        self.room = self.t + 4 + self.t // 2
        self.at = np.cumsum(self.room) - self.room
        self.sizes = np.zeros(int(self.room.sum()), np.int64)
        rank = np.arange(len(dish)) - np.repeat(np.cumsum(self.t) - self.t, self.t)
        self.sizes[self.at[dish] + rank] = size

    def _widen(self) -> None:
        if (self.used == self.room).any():
            dish = np.repeat(np.arange(len(self.t)), self.room)
            taken = self.sizes > 0
            self._lay(dish[taken], self.sizes[taken])

    def _leave(self, who: np.ndarray) -> np.ndarray:
        """A random customer of each dish gets up; the tables they sat at."""
        ends = np.cumsum(self.sizes)
        before = np.where(self.at[who] > 0, ends[self.at[who] - 1], 0)
        seat = np.searchsorted(ends, before + (self.rng.random(len(who)) * self.c[who]).astype(np.int64), side="right")
        self.sizes[seat] -= 1
        self.c[who] -= 1
        self.t[who] -= self.sizes[seat] == 0
        return seat

    def _enter(self, who: np.ndarray, strength: np.ndarray, left: np.ndarray | None = None) -> None:
        """One customer of each dish sits down: at a table in proportion to its size less the discount, or at a new one."""
        old = self.c[who] - self.d * self.t[who]
        u = self.rng.random(len(who)) * (strength + old)
        new = (u < strength) | (self.t[who] == 0)
        ends = np.cumsum(np.where(self.sizes > 0, self.sizes - self.d, 0.0))
        before = np.where(self.at[who] > 0, ends[self.at[who] - 1], 0.0)
        seat = np.minimum(np.searchsorted(ends, before + (u - strength), side="right"), self.at[who] + self.room[who] - 1)
        seat = np.maximum(seat, self.at[who])
        new |= self.sizes[seat] == 0  # only by rounding at the very end
        free = self.at[who] + self.used[who]
        if left is not None:
            reuse = new & (self.sizes[left] == 0)
            free = np.where(reuse, left, free)
        else:
            reuse = np.zeros(len(who), bool)
        self.used[who] += new & ~reuse
        seat = np.where(new, free, seat)
        self.sizes[seat] += 1
        self.c[who] += 1
        self.t[who] += new

    def sweep(self, strength: np.ndarray) -> None:
        """A customer of every dish with several gets up and is seated anew."""
        self._widen()
        who = np.flatnonzero(self.c > 1)
        if len(who):
            left = self._leave(who)
            self._enter(who, strength[who], left)

    def resize(self, customers: np.ndarray, strength: np.ndarray) -> None:
        """Customers come or go until each dish has as many as given."""
        while len(who := np.flatnonzero(self.c > customers)):
            self._leave(who)
        while len(who := np.flatnonzero(self.c < customers)):
            self._widen()
            self._enter(who, strength[who])


def log_gap(u: np.ndarray) -> np.ndarray:
    """log(1 - e^u), for u near 0 as well as far below."""
    out = np.log(-np.expm1(u))
    below = u.real < -1
    if below.any():
        z = -np.exp(u[below])
        # numpy's own log1p of complex numbers loses the small ones
        out[below] = np.log1p(z) if z.dtype.kind == "f" else 0.5 * np.log1p(z.real * (2 + z.real) + z.imag**2) + 1j * np.arctan2(z.imag, 1 + z.real)
    return out


def sibuya_power(c: np.ndarray, t: np.ndarray, d: float, nodes: int = 30) -> np.ndarray:
    """log of the coefficient of z^c in (1 - (1 - z)^d)^t, for c in the hundreds or more, by a contour integral.

    With u = log z the integrand is exp(t log(1 - (1 - e^u)^d) - c u). The contour is a parabola through its saddle point
    along the path of steepest descent. A saddle nearer to the branch point 0 than 4/c is no guide: there the parabola
    goes around 0 at the scale of 1/c, where a power near 1 is taken less 1, whose integral is 0. A saddle so flat that it fills the circle is
    summed over the circle.
    """
    low, high = np.full(len(c), -60.0), np.full(len(c), 3.4)
    for _ in range(50):  # the saddle u = -e^x, where the tilted mean of one table is c / t
        x = (low + high) / 2
        u = -np.exp(x)
        w = log_gap(u)
        wide = t * d * np.exp((d - 1) * w + u) > -c * np.expm1(d * w)
        low, high = np.where(wide, x, low), np.where(wide, high, x)
    s = np.exp((low + high) / 2)
    near = s * c < 4
    u = -np.where(near, 4 / c, s)

    # derivatives of log(1 - w^d) for w = 1 - e^u, where w' = w - 1
    w, w1 = np.exp(log_gap(u)), -np.exp(u)
    g = -np.expm1(d * log_gap(u))
    p1, p2, p3 = d * w ** (d - 1), d * (d - 1) * w ** (d - 2), d * (d - 1) * (d - 2) * w ** (d - 3)
    r1, r2, r3 = -p1 * w1 / g, -(p2 * w1**2 + p1 * w1) / g, -(p3 * w1**3 + 3 * p2 * w1 * w1 + p1 * w1) / g
    f2, f3 = np.maximum(t * (r2 - r1**2), 1e-9), t * (r3 - 3 * r1 * r2 + 2 * r1**3)
    bend, far = np.where(near, -1 / (4 * u), f3 / (6 * f2)), np.where(near, -6 * u, 9 / np.sqrt(f2))
    flat = ~near & (far > 2.5)
    bend, far = np.where(flat, 0.0, bend), np.where(flat, np.pi, far)
    lost = near & (t * np.log(g) > -0.7)
    top, total = np.where(lost, 0.0, t * np.log(g)) - c * u, 0.0
    for k in range(nodes):  # the other half is conjugate
        y = far * (k + 0.5) / nodes
        z = u + 1j * y + bend * y * y
        power = t * np.log(-np.expm1(d * log_gap(z)))
        value = np.exp(np.where(lost, 0, power) - c * z - top)
        value[lost] *= np.expm1(power[lost])
        total = total + (value * (1 - 2j * bend * y)).real
    return top + np.log(total * far / (nodes * np.pi))


class Tables:
    """Numbers of tables of many dishes, all customers of all dishes seated anew by each draw.

    Given its count c and strength a, a dish has t tables with probability in proportion to a^t S(c, t), where S are the
    generalised Stirling numbers of the discount: S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t). Dishes of up to ``SMALL``
    customers take S from that recursion, all t. For larger ones S(c, t) = c! / (t! d^t) [z^c] (1 - (1 - z)^d)^t is integrated
    numerically at evenly spaced t, some 10 standard deviations to each side, and interpolated if they are not all t there; a
    dish whose strength leads it away gets a new grid.
    """

    SMALL, GRID = 256, 65

    def __init__(self, customers: np.ndarray, discount: float, rng: np.random.Generator, tables: np.ndarray | None = None):
        self.c, self.d, self.rng = customers.astype(np.int64), discount, rng
        self.t = np.minimum(self.c, 1) if tables is None else tables.astype(np.int64)
        most = int(min(self.SMALL, self.c.max(initial=1)))
        known = np.full((most + 1, most + 1), -np.inf)
        known[1, 1:2] = 0.0
        n = np.arange(most + 1)
        for c in range(1, most):
            with np.errstate(divide="ignore"):
                stay = known[c] + np.log(np.maximum(c - discount * n, 0))
            known[c + 1] = np.logaddexp(stay, np.concatenate([[-np.inf], known[c, :-1]]))
        self.small, self.large = np.flatnonzero((self.c > 1) & (self.c <= self.SMALL)), np.flatnonzero(self.c > self.SMALL)
        own, t = self._ragged(np.ones(len(self.small), np.int64), self.c[self.small])
        self.few = (own, t, known[self.c[self.small][own], t])
        self.low, self.high = np.ones(len(self.large), np.int64), np.zeros(len(self.large), np.int64)
        self.logs = np.zeros((len(self.large), self.GRID))
        self.many = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    @staticmethod
    def _ragged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of ranges, and the numbers from low to high of each."""
        n = high - low + 1
        own = np.repeat(np.arange(len(n)), n)
        return own, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[own]

    def _grids(self, strength: np.ndarray) -> None:
        """New grids for large dishes whose likely numbers of tables are not well inside the present one."""
        c = self.c[self.large].astype(float)
        low, high = np.full(len(c), -60.0), np.full(len(c), 6.0)
        for _ in range(40):
            x = (low + high) / 2
            u = -np.exp(x)
            wide = strength * np.exp((self.d - 1) * log_gap(u) + u) > c
            low, high = np.where(wide, x, low), np.where(wide, high, x)
        # tables are close to a Poisson number, given that their sizes, tilted to the right mean, add up
        gap = log_gap(u)
        mass, mean = -np.expm1(self.d * gap), self.d * np.exp((self.d - 1) * gap + u)
        square = mean + self.d * (1 - self.d) * np.exp((self.d - 2) * gap + 2 * u)
        likely = np.minimum(c, 1 + strength / self.d * mass)
        spread = np.sqrt(likely * np.maximum(0, 1 - mean * mean / (mass * square)))
        cut = lambda k: (np.maximum(1, np.floor(likely - k * (spread + 1.2))).astype(np.int64), np.minimum(c, np.ceil(likely + k * (spread + 1.2))).astype(np.int64))
        (a, b), (first, last) = cut(6), cut(10)
        off = np.flatnonzero((a < self.low) | (b > self.high))
        if not len(off):
            return
        whole, steps = self.c[self.large][off], self.GRID - 1
        apart = np.minimum(-(-(last - first)[off] // steps), (whole - 1) // steps)
        self.low[off] = np.maximum(1, np.minimum(first[off], whole - steps * apart))
        self.high[off] = self.low[off] + steps * apart
        at = self.low[off, None] + apart[:, None] * np.arange(self.GRID)
        flat = at.ravel().astype(float)
        gamma = np.frompyfunc(math.lgamma, 1, 1)(flat + 1).astype(float)
        logs = sibuya_power(np.repeat(c[off], self.GRID), flat, self.d) - gamma - flat * math.log(self.d)
        self.logs[off] = logs.reshape(len(off), self.GRID)
        # cubic interpolation between the points of the grid
        own, t = self._ragged(self.low, self.high)
        x = (t - self.low[own]) / (self.high - self.low)[own] * (self.GRID - 1)
        i = np.clip(x.astype(np.int64), 1, self.GRID - 3)
        x = x - i
        y = [self.logs[own, i + k] for k in (-1, 0, 1, 2)]
        value = -x * (x - 1) * (x - 2) / 6 * y[0] + (x * x - 1) * (x - 2) / 2 * y[1] - x * (x + 1) * (x - 2) / 2 * y[2] + x * (x * x - 1) / 6 * y[3]
        self.many = (own, t, value)

    def _draw(self, who: np.ndarray, options: tuple[np.ndarray, np.ndarray, np.ndarray], strength: np.ndarray) -> None:
        if not len(who):
            return
        own, t, logs = options
        start = np.searchsorted(own, np.arange(len(who)))
        score = logs + t * np.log(np.maximum(strength, 1e-300))[own]
        ends = np.cumsum(np.exp(score - np.maximum.reduceat(score, start)[own]))
        before = np.where(start > 0, ends[start - 1], 0.0)
        last = np.append(start[1:], len(own)) - 1
        at = np.searchsorted(ends, before + self.rng.random(len(who)) * (ends[last] - before), side="right")
        self.t[who] = t[np.clip(at, start, last)]

    def sweep(self, strength: np.ndarray) -> None:
        """The number of tables of every dish with several customers, given the strength of each."""
        self._draw(self.small, self.few, strength[self.small])
        if len(self.large):
            self._grids(np.maximum(strength[self.large], 1e-12))
            self._draw(self.large, self.many, strength[self.large])


def text_blocks(docs: DataFrame, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    """Documents in blocks of some million tokens: ids, the block's own word list, and the tokens as places in it."""

    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("words", pa.binary()), ("tokens", pa.binary())])

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[bytes, int] = {END: 0}
        ids, held, tokens, number = [], [], [], 0

        def finished() -> pa.RecordBatch:
            row = {"block": [(TaskContext.get().partitionId() << 32) + number], "ids": [ids], "held": [held], "words": [squeezed(b"\n".join(place))], "tokens": [squeezed(np.concatenate(tokens))]}
            return pa.RecordBatch.from_pydict(row, schema=schema)

        total = 0
        for batch in batches:
            for doc, text, out in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                own = words(text)
                own.append(END)
                for w in own:
                    if w not in place:
                        place[w] = len(place)
                tokens.append(np.fromiter(map(place.__getitem__, own), np.uint32, len(own)))
                ids.append(doc)
                held.append(out)
                total += len(own)
                if total >= BLOCK_TOKENS:
                    yield finished()
                    number, total = number + 1, 0
                    place = {END: 0}
                    ids, held, tokens = [], [], []
        if ids:
            yield finished()

    given = docs.select(F.col(id_col).cast("long"), text_col, held_out)
    return given.mapInArrow(blocked, "block long, ids array<long>, held array<boolean>, words binary, tokens binary")


class Block:
    """One block, opened: the word list, the tokens, where documents start, and which tokens are learned from."""

    def __init__(self, held: list[bool], listed: bytes, tokens: bytes):
        self.words = opened(listed)[0].split(b"\n")
        self.tokens = opened(tokens)[0].astype(np.int64)
        ends = np.flatnonzero(self.tokens == 0)
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        self.lengths = ends - self.starts + 1
        self.learned = np.repeat(~np.array(held, bool), self.lengths)

    def last_frequent(self, kind: np.ndarray) -> np.ndarray:
        """For each token the kind of the nearest frequent word before it in its text, -1 if there is none."""
        kinds = kind[self.tokens]
        at = np.maximum.accumulate(np.where(kinds >= 0, np.arange(len(kinds)), -1))
        before = np.concatenate([[-1], at[:-1]])
        return np.where(before >= np.repeat(self.starts, self.lengths), kinds[np.maximum(before, 0)], -1)

    def pairs(self, classes: dict[bytes, int], contexts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of a word and its restaurant, in ascending order, and the number of each token's pair.

        A restaurant is a preceding word (the end, before the first word of a text) and a class context. Returns the words, the
        restaurants as ``preceding word * contexts + context``, and the numbers.
        """
        kind = np.array([classes.get(w, -1) for w in self.words], np.int64)
        before = np.concatenate([[0], self.tokens[:-1]]) if classes else np.zeros(len(self.tokens), np.int64)
        wide = len(self.words) * contexts
        code, at = np.unique(self.tokens * wide + before * contexts + self.last_frequent(kind) + 1, return_inverse=True)
        return code // wide, code % wide, at


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, Block(row["held"], row["words"], row["tokens"])


def frequent_words(blocks: DataFrame, most: int) -> list[bytes]:
    """The most frequent words of the training tokens; a block counts those that make up 1/20000 of its tokens or more."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in read_blocks(batches):
            n = np.bincount(block.tokens[block.learned], minlength=len(block.words))
            at = np.flatnonzero(n * 20_000 >= max(n.sum(), 1))
            at = at[at > 0]
            yield pa.RecordBatch.from_pydict({"word": pa.array([block.words[i] for i in at], pa.binary()), "n": n[at].astype(np.int64)})

    got = blocks.mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).collect()
    return [bytes(r.word) for r in got]


def word_classes(blocks: DataFrame, frequent: list[bytes], classes: int) -> dict[bytes, int]:
    """Frequent words in classes by the frequent words that come next to them: k-means on a matrix of bounded size."""
    number = {w: i for i, w in enumerate(frequent)}
    m = len(frequent)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m * m, np.int64)
        for _, block in read_blocks(batches):
            kind = np.array([number.get(w, -1) for w in block.words], np.int64)
            before, own = block.last_frequent(kind), kind[block.tokens]
            both = block.learned & (before >= 0) & (own >= 0)
            total += np.bincount(before[both] * m + own[both], minlength=m * m)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": at, "n": total[at]})

    if not m:
        return {}
    got = blocks.mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    near = np.zeros(m * m)
    near[got["at"].to_numpy()] = got["n"].to_numpy()
    near = near.reshape(m, m)
    x = np.hstack([near, near.T])
    x = np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1))
    centres = x[:1]
    while len(centres) < min(classes, m):  # the word farthest from all centres is the next one
        centres = np.vstack([centres, x[np.argmax(((x[:, None] - centres) ** 2).sum(2).min(1))]])
    for _ in range(20):
        of = np.argmin(((x[:, None] - centres) ** 2).sum(2), axis=1)
        centres = np.array([x[of == k].mean(0) if (of == k).any() else centres[k] for k in range(len(centres))])
    return dict(zip(frequent, of.tolist()))


def requests(blocks: DataFrame, classes: dict[bytes, int], contexts: int, buckets: int) -> DataFrame:
    """What each block holds of each bucket of words: its words, and their restaurants with the training counts.

    Restaurants go by 64-bit hashes of the preceding word and the class context.
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in read_blocks(batches):
            word, place, at = block.pairs(classes, contexts)
            n = np.bincount(at[block.learned], minlength=len(word)).astype(np.uint32)
            home = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in block.words), np.int64, len(block.words))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, block.words), np.uint64, len(block.words))
            order = np.argsort(home[word], kind="stable")
            cuts = np.searchsorted(home[word][order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[b] : cuts[b + 1]]
                own, sizes = np.unique(word[mine], return_counts=True)
                seat, where = np.unique(place[mine], return_inverse=True)
                context = (seat % contexts).astype(np.uint8)
                name = mix(hashes[seat // contexts] + context * np.uint64(MULTIPLIERS[0]))
                blob = squeezed(b"\n".join([block.words[i] for i in own]), sizes.astype(np.uint32), where.astype(np.uint32), n[mine], name, context)
                yield pa.RecordBatch.from_pydict({"bucket": [int(b)], "block": [row["block"]], "asked": [blob]}, schema=schema)

    schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("asked", pa.binary())])
    return blocks.mapInArrow(asked, "bucket long, block long, asked binary")


PLAIN = ("tokens", "kinds", "deep_once", "deep_twice", "once", "twice", "root_once", "root_twice")
VOCABULARY = "bucket long, held binary, part binary, blocks array<long>, asks array<binary>, " + ", ".join(f"{c} long" for c in PLAIN) + ", customers array<double>, tables array<double>"


def merged_words(asked: DataFrame, contexts: int, buckets: int) -> DataFrame:
    """One row per bucket: its words with their training counts by restaurant, and the sums that all buckets add up.

    ``held`` is the words, the dishes of class contexts (word, context, restaurants that serve it) and the dishes of restaurants
    (the class dish above, the restaurant, customers). Pairs without customers, which texts to be scored ask for, are dishes of
    none. ``part`` goes to the buckets that add up restaurants (``pooled``): where each starts in the list, the names, their
    customers and dishes. ``asks`` says for each block which words and dishes it asked for.
    """

    def merged(group: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        blobs, words_of = [opened(x) for x in group["asked"].to_pylist()], []
        for listed, sizes, *_ in blobs:
            of = np.fromiter((place.setdefault(w, len(place)) for w in listed.split(b"\n")), np.int64)
            words_of.append(np.repeat(of, sizes))
        names, first, at = np.unique(np.concatenate([x[4] for x in blobs]), return_index=True, return_inverse=True)
        order = np.argsort(names % np.uint64(buckets), kind="stable")
        names, kind = names[order], np.concatenate([x[5] for x in blobs])[first][order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = np.split(rank[at], np.cumsum([len(x[4]) for x in blobs])[:-1])
        code, at = np.unique(np.concatenate([w * len(names) + own[x[2]] for w, own, x in zip(words_of, at, blobs)]), return_inverse=True)
        c = np.bincount(at, np.concatenate([x[3] for x in blobs]), len(code)).astype(np.int64)
        asks = zip(words_of, blobs, np.split(at, np.cumsum([len(x[2]) for x in blobs])[:-1]))
        asks = [squeezed(w[np.cumsum(x[1], dtype=np.int64) - 1].astype(np.uint32), i.astype(np.uint32)) for w, x, i in asks]
        seat = code % len(names)
        upper, parent = np.unique(code // len(names) * contexts + kind[seat], return_inverse=True)
        word, context, served = upper // contexts, upper % contexts, np.bincount(parent, c > 0, len(upper)).astype(np.int64)
        own = np.bincount(word, served > 0, len(place))
        held = squeezed(b"\n".join(place), word.astype(np.uint32), context.astype(np.uint8), served, parent.astype(np.uint32), seat.astype(np.uint32), c.astype(np.uint32))
        part = squeezed(homes(names, buckets), names, np.bincount(seat, c, len(names)).astype(float), np.bincount(seat, c > 0, len(names)).astype(np.float32))
        n = [c.sum(), (own > 0).sum(), (c == 1).sum(), (c == 2).sum(), (served == 1).sum(), (served == 2).sum(), (own == 1).sum(), (own == 2).sum()]
        sums = {"bucket": [group["bucket"][0].as_py()], "held": [held], "part": [part], "blocks": [group["block"].to_pylist()], "asks": [asks], **{k: [int(v)] for k, v in zip(PLAIN, n)}}
        both = {k: [np.bincount(context, x, contexts).astype(float).tolist()] for k, x in (("customers", served), ("tables", served > 0))}
        return pa.table({**sums, **both}, schema=schema)

    sums = pa.list_(pa.float64())
    blocks = [("blocks", pa.list_(pa.int64())), ("asks", pa.list_(pa.binary()))]
    schema = pa.schema([("bucket", pa.int64()), ("held", pa.binary()), ("part", pa.binary()), *blocks, *[(c, pa.int64()) for c in PLAIN], ("customers", sums), ("tables", sums)])
    return asked.groupBy("bucket").applyInArrow(merged, VOCABULARY)


def homes(names: np.ndarray, buckets: int) -> np.ndarray:
    """Where the restaurants of each bucket start in a list ordered by bucket."""
    return np.searchsorted(names % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))


def pooled(parts: DataFrame, buckets: int) -> DataFrame:
    """Customers and tables of each restaurant, summed over all buckets of words and returned to those that know it.

    A part lists keys, which are names at first and then the numbers that this returns, by the bucket that adds them up.
    Returns one row per bucket, in the order of its part: where each home starts, numbers, customers, tables.
    """

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cuts, keys, customers, tables = opened(part)
                for home in np.flatnonzero(np.diff(cuts)):
                    x = slice(cuts[home], cuts[home + 1])
                    # ascending keys: their steps are stored
                    blob = squeezed(np.diff(keys[x], prepend=keys.dtype.type(0)), customers[x], tables[x])
                    yield pa.RecordBatch.from_pydict({"home": [int(home)], "bucket": [bucket], "part": [blob]}, schema=schema)

    def added(group: pa.Table) -> pa.Table:
        blobs = [opened(x) for x in group["part"].to_pylist()]
        keys, at = np.unique(np.concatenate([np.cumsum(x[0], dtype=x[0].dtype) for x in blobs]), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([x[i] for x in blobs]), len(keys)).astype(kind) for i, kind in ((1, np.float64), (2, np.float32))]
        ends = np.cumsum([len(x[0]) for x in blobs])[:-1]
        back = [squeezed(np.diff(i.astype(np.uint32), prepend=np.uint32(0)), *[s[i] for s in sums]) for i in np.split(at, ends)]
        return pa.table({"home": group["home"], "bucket": group["bucket"], "part": pa.array(back, pa.binary())})

    def gathered(group: pa.Table) -> pa.Table:
        group = group.sort_by("home")
        blobs = [opened(x) for x in group["part"].to_pylist()]
        sizes = np.bincount(group["home"].to_numpy(), [len(x[0]) for x in blobs], buckets).astype(np.int64)
        keys = np.concatenate([np.cumsum(x[0], dtype=np.uint32) for x in blobs])
        share = squeezed(np.concatenate([[0], np.cumsum(sizes)]), keys, *[np.concatenate([x[i] for x in blobs]) for i in (1, 2)])
        return pa.table({"bucket": [group["bucket"][0].as_py()], "share": [share]})

    schema = pa.schema([("home", pa.int64()), ("bucket", pa.int64()), ("part", pa.binary())])
    kinds = "home long, bucket long, part binary"
    back = parts.select("bucket", "part").mapInArrow(dealt, kinds).groupBy("home").applyInArrow(added, kinds)
    return back.groupBy("bucket").applyInArrow(gathered, "bucket long, share binary")


@dataclass(frozen=True)
class Totals:
    """Sums over all class contexts: customers and tables of each, and the parameters."""

    tokens: int
    kinds: int
    discount: float
    root_discount: float
    customers: np.ndarray
    tables: np.ndarray
    strength: float
    deep_discount: float = 0.5

    def root(self, customers: np.ndarray) -> np.ndarray:
        """Root probabilities of words that have tables in some contexts."""
        return np.maximum(customers - self.root_discount, 0) / (self.strength + self.tables.sum())

    def new_word(self) -> float:
        """Root probability of a word that was never seen."""
        return (self.strength + self.root_discount * self.kinds) / (self.strength + self.tables.sum())

    def fresh(self) -> np.ndarray:
        """For each context the probability of a new table, whose dish the root chooses."""
        return (self.strength + self.discount * self.tables) / (self.strength + self.customers)

    def seen(self, context: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """For dishes of contexts the probability of a seat at one of their tables."""
        return (customers - self.discount * tables) / (self.strength + self.customers[context])


def seated(vocabulary: DataFrame, before: DataFrame | None, totals: Totals, settings: Settings, shares: DataFrame | None = None) -> DataFrame:
    """Gibbs sampling of all restaurants, each bucket's dishes given the tables of all others.

    Dishes of a word in all restaurants are in one bucket, so all customers of a word, up to the root, are at hand. A sweep
    seats all customers of all dishes anew: those of the preceding words' restaurants given the probabilities of the classes
    above, then their tables, which are customers of the classes, given the root's customers. The upper probabilities are those
    before the draw, the dish's own tables included, so restaurants of one word are drawn together and not one after the other.
    The first round starts with the tables that sequential seating gives, the next with the last sample of the round ``before``.
    ``shares`` has customers and tables of the restaurants (``pooled``); without them, classes are the lowest level. Returns for
    each bucket averaged tables, customers and root customers, its part of the restaurants' tables, and the last sample.
    """

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, held, state, share in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rng = np.random.default_rng([bucket, state is not None])
                listed, word, context, c, *below = opened(held)
                size, word = listed.count(b"\n") + 1, word.astype(np.int64)
                opening, fresh = (totals.strength + totals.discount * totals.tables)[context], totals.fresh()[context]
                root = lambda t: totals.root(np.bincount(word, t, size))[word]
                begin = lambda a, c: np.clip(np.rint(a * np.log1p(c / a)), 1, c)
                known = opened(state) if state else None
                if below:
                    parent, seat, own = below
                    cuts, numbers, _, tables = opened(share)
                    wide = (totals.strength + totals.deep_discount * tables.astype(float))[seat]
                    upper = lambda c, t: np.maximum(wide * (totals.seen(context, c, t) + fresh * root(t))[parent], 1e-12)
                    deep = Tables(own, totals.deep_discount, rng, known[1] if known else begin(upper(c, np.ones(len(c))), own))
                    c = np.bincount(parent, deep.t, len(c)).astype(np.int64)
                a = np.maximum(opening * root(np.ones(len(c))), 1e-12)
                seats = Tables(c, totals.discount, rng, known[0] if known else begin(a, c))
                kept = []
                for i in range(settings.burn + settings.samples):
                    if below:
                        deep.sweep(upper(seats.c, seats.t))
                        c = np.bincount(parent, deep.t, len(c)).astype(np.int64)
                        seats = Tables(c, totals.discount, rng, np.minimum(seats.t, c))
                    seats.sweep(opening * root(seats.t))
                    if i >= settings.burn:
                        now = [seats.t, seats.c, deep.t if below else seats.t[:0]]
                        kept = [x + y / settings.samples for x, y in zip(kept, now)] if kept else [x / settings.samples for x in now]
                t, c, low = kept or [seats.t, seats.c, deep.t if below else seats.t[:0]]
                answer = squeezed(*[x.astype(np.float32) for x in (t, np.bincount(word, t, size), c, low)])
                part = squeezed(cuts, numbers, np.bincount(seat, own, len(numbers)).astype(float), np.bincount(seat, low, len(numbers)).astype(np.float32)) if below else None
                row = {"bucket": [bucket], "seats": [answer], "state": [squeezed(seats.t, deep.t) if below else squeezed(seats.t)], "part": [part]}
                both = {k: [np.bincount(context, x, len(totals.tables)).astype(float).tolist()] for k, x in (("customers", c), ("tables", t))}
                yield pa.RecordBatch.from_pydict({**row, **both}, schema=schema)

    sums = pa.list_(pa.float64())
    schema = pa.schema([("bucket", pa.int64()), ("seats", pa.binary()), ("state", pa.binary()), ("part", pa.binary()), ("customers", sums), ("tables", sums)])
    held = vocabulary.select("bucket", "held")
    held = held.join(before.select("bucket", "state"), "bucket") if before is not None else held.withColumn("state", F.lit(None).cast("binary"))
    held = held.join(shares, "bucket") if shares is not None else held.withColumn("share", F.lit(None).cast("binary"))
    return held.mapInArrow(sampled, "bucket long, seats binary, state binary, part binary, customers array<double>, tables array<double>")


def answers(known: DataFrame, totals: Totals) -> DataFrame:
    """For each request of a block the training count of its words and the log10 probability of its (word, restaurant) pairs."""

    schema = pa.schema([("of", pa.int64()), ("bucket", pa.int64()), ("answer", pa.binary())])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, held, seats, share, blocks, asks in zip(*(batch.column(i).to_pylist() for i in range(6))):
                listed, word, context, _, parent, seat, own = opened(held)
                mean, root, customers, low = opened(seats)
                _, _, sat, tables = opened(share)
                total = np.bincount(word[parent], own, listed.count(b"\n") + 1).astype(np.int64)
                base = np.where(total > 0, totals.root(root), totals.new_word())
                upper = totals.seen(context, customers, mean) + totals.fresh()[context] * base[word]
                opening = (totals.strength + totals.deep_discount * tables.astype(float)) / (totals.strength + sat)
                logs = np.log10((own - totals.deep_discount * low) / (totals.strength + sat[seat]) + opening[seat] * upper[parent]).astype(np.float32)
                for block, blob in zip(blocks, asks):
                    words_of, dishes = opened(blob)
                    yield pa.RecordBatch.from_pydict({"of": [block], "bucket": [bucket], "answer": [squeezed(total[words_of], logs[dishes])]}, schema=schema)

    return known.select("bucket", "held", "seats", "share", "blocks", "asks").mapInArrow(answered, "of long, bucket long, answer binary")


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Learn from the rows that are not ``held_out`` and score all: one row per input row.

    Columns: the id, held_out, n_tokens, n_known, train_tokens, base_score (add-half unigrams), score (log10 probability by the
    model) and perplexity per token. Tokens are words, A-Z lower-cased, and one end for each text.

    The model: every training token is a customer in the restaurant of the word before it (the end, at the start of a text) under
    the class of the nearest frequent word before it. The parent of a restaurant is that of its class alone, whose parent is
    the root; each table of a restaurant is a customer of its parent. The root's base is diffuse, so a new table of the root
    serves a word never seen, and all those words are one event, as in the base score. Tables are seated by Gibbs sampling in
    rounds, each from the seating of the last; within one, a bucket of words is sampled given the number of tables of each
    restaurant at the round's start. Predictive probabilities are averaged over the samples of the last round. Each of the three
    levels has its discount, from the numbers of dishes with one and two customers when every dish below has one table.

    All training texts count, whole, and every preceding word is a context. Blocks of texts exchange their distinct (word, restaurant)
    pairs with buckets of words, and those exchange the sums of restaurants, which no word's bucket knows alone. There are as many
    buckets as blocks. Restaurants go by 64-bit hashes.

    Null texts count as empty: one token, the end. Repeated rows count and are scored each. A null ``held_out`` counts as
    false. Ties among frequent words go by their bytes. Without training rows every word is new. Empty tables give
    empty ones; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    blocks = materialise(text_blocks(docs, id_col, text_col, F.coalesce(held_out, F.lit(False))), "blocks")
    buckets = max(1, blocks.select("block").count())
    contexts = settings.classes + 1
    classes = word_classes(blocks, frequent_words(blocks, settings.frequent), settings.classes)
    vocabulary = materialise(merged_words(requests(blocks, classes, contexts, buckets), contexts, buckets), "vocabulary")

    def summed(df: DataFrame, column: str) -> np.ndarray:
        """Sums of an array column by place."""
        got = df.select(F.posexplode(column).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
        out = np.zeros(contexts)
        for r in got:
            out[r["at"]] = r["n"]
        return out

    sums = vocabulary.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PLAIN]).first()
    estimated = lambda once, twice: min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    totals = Totals(
        sums.tokens, sums.kinds, estimated(sums.once, sums.twice), estimated(sums.root_once, sums.root_twice), summed(vocabulary, "customers"), summed(vocabulary, "tables"), settings.strength,
        estimated(sums.deep_once, sums.deep_twice),
    )
    seats, shares = None, materialise(pooled(vocabulary, buckets), "shares")
    for _ in range(settings.rounds):
        seats = materialise(seated(vocabulary, seats, totals, settings, shares), "seats")
        totals = replace(totals, customers=summed(seats, "customers"), tables=summed(seats, "tables"))
        shares = materialise(pooled(seats, buckets), "shares")
    known = vocabulary.select("bucket", "held", "blocks", "asks").join(seats.select("bucket", "seats"), "bucket").join(shares, "bucket")
    found = materialise(answers(known, totals), "answers")

    def scored(block: pa.Table, found: pa.Table) -> pa.Table:
        ids, held = block["ids"][0].as_py(), block["held"][0].as_py()
        opened_block = Block(held, block["words"][0].as_py(), block["tokens"][0].as_py())
        word, _, at = opened_block.pairs(classes, contexts)
        home = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in opened_block.words), np.int64, len(opened_block.words))
        total, logs = np.zeros(len(opened_block.words), np.int64), np.zeros(len(word))
        order = np.argsort(home[word], kind="stable")
        cuts = np.searchsorted(home[word][order], np.arange(buckets + 1))
        for bucket, answer in zip(found["bucket"].to_pylist(), found["answer"].to_pylist()):
            mine = order[cuts[bucket] : cuts[bucket + 1]]
            counts, p = opened(answer)
            total[np.unique(word[mine])] = counts
            logs[mine] = p
        c = total[opened_block.tokens]
        add = lambda v: np.add.reduceat(v, opened_block.starts)
        return pa.table({
            "id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": opened_block.lengths, "n_known": add((c > 0).astype(np.int64)),
            "train_tokens": np.full(len(ids), totals.tokens, np.int64), "base_score": add(np.log10((c + 0.5) / (totals.tokens + 0.5 * (totals.kinds + 1)))), "score": add(logs[at]),
        })

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = blocks.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(scored, schema)
    return out.withColumnRenamed("id", id_col).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
