"""Toxicity by compression distance: windows of a text are compressed with a dictionary of toxic and one of ordinary text."""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, materialise


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, sizes in bytes, and the compression level."""

    most_toxic: int = 3000  # labelled rows of each class that training reads, chosen by a hash of the id
    most_ordinary: int = 6000
    window: int = 64
    level: int = 9
    shared_bytes: int = 64_000  # ordinary language, held by both dictionaries so that it costs the same in both
    own_bytes: int = 8_000  # what only one of the classes says
    least_contexts: int = 8
    least_z: float = 4.0
    most_words: int = 1000


def windows(text: bytes, size: int) -> list[bytes]:
    """The whole text, lower-cased A-Z and with single blanks, in runs of whole words of ``size`` bytes or a little more."""
    out, run, n = [], [], 0
    for word in text.lower().split():
        run.append(word)
        n += len(word) + 1
        if n >= size:
            out.append(b" ".join(run))
            run, n = [], 0
    if run:
        out.append(b" ".join(run))
    return out


def contexts(texts: Iterable[bytes]) -> Counter:
    """For each word the number of distinct words before it, so that copies of a text count once."""
    n: Counter = Counter()
    seen = set()
    for text in texts:
        before = b""
        for word in text.lower().split():
            if (before, word) not in seen:
                seen.add((before, word))
                n[word] += 1
            before = word
    return n


def telling_words(own: Counter, other: Counter, settings: Settings) -> set[bytes]:
    """Words whose contexts are significantly more frequent in one class: above ``least_z`` standard errors, and fourfold."""
    a, b = max(sum(own.values()), 1), max(sum(other.values()), 1)
    scored = []
    for word, n in own.items():
        p = (n + other[word]) / (a + b)
        z = (n / a - other[word] / b) / math.sqrt(max(p * (1 - p), 1e-12) * (1 / a + 1 / b))
        if n >= settings.least_contexts and z > settings.least_z and n * b > 4 * other[word] * a:
            scored.append((-z, word))
    return {w for _, w in sorted(scored)[: settings.most_words]}


def trained(samples: list[bytes], size: int, **how: int) -> bytes:
    """Content of a zstandard dictionary trained on the samples; what there is of them if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size + 2_000, samples, **how).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


class Compressors:
    """The two dictionaries in use; made once in each Python worker."""

    def __init__(self, toxic: bytes, ordinary: bytes, level: int):
        self.toxic, self.ordinary, self.pair = toxic, ordinary, []
        for content in (ordinary, toxic):
            held = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.pair.append(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window, against the ordinary one."""
        ordinary, toxic = (c.compress for c in self.pair)
        return np.array([len(ordinary(p)) - len(toxic(p)) for p in parts], np.float64)


def features(gains: np.ndarray) -> np.ndarray:
    """What the threshold is calibrated on: mean, largest and second gains, and the share of windows with a clear gain."""
    top = np.sort(gains)[-2:]
    n = len(gains)
    return np.array([1.0, gains.mean(), top[-1], top.mean(), (gains >= 4).mean(), math.log(n), top[-1] / math.log(n + 2)])


class Model:
    """Dictionaries and the calibrated weights; a few hundred kilobytes whatever the size of the input."""

    def __init__(self, toxic: bytes, ordinary: bytes, settings: Settings, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray):
        self.toxic, self.ordinary, self.settings = toxic, ordinary, settings
        self.centre, self.spread, self.weights = centre, spread, weights

    def score(self, gains: np.ndarray) -> float:
        z = float(((features(gains) - self.centre) / self.spread) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def prior(self) -> float:
        """The score of a text without words: that of a text whose windows gain nothing."""
        return self.score(np.zeros(1))


def dictionaries(rows: list[tuple[bytes, int]], settings: Settings) -> Compressors:
    """One dictionary for each class: what only that class says, before the ordinary language that both hold."""
    toxic, ordinary = [t for t, y in rows if y], [t for t, y in rows if not y]
    a, b = contexts(toxic), contexts(ordinary)

    def telling(texts: list[bytes], words: set[bytes]) -> list[bytes]:
        """What the windows hold of the telling words, in their order."""
        found = (b" ".join(w for w in part.split() if w in words) for text in texts for part in windows(text, settings.window))
        return [x for x in found if x]

    shared = trained([w for t in ordinary for w in windows(t, settings.window)][:100_000], settings.shared_bytes)
    own = [trained(telling(texts, telling_words(x, y, settings)), settings.own_bytes, k=32, d=6) for texts, x, y in ((toxic, a, b), (ordinary, b, a))]
    return Compressors(own[0] + shared, own[1] + shared, settings.level)


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, spread and weights of a penalised logistic regression."""
    centre, spread = x.mean(0), x.std(0) + 1e-9
    centre[0], spread[0] = 0, 1
    z = (x - centre) / spread
    weights = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, z.T @ (y - p) - 1e-2 * weights)
    return centre, spread, weights


def fit(rows: list[tuple[bytes, int]], settings: Settings) -> Model | None:
    """Dictionaries from all rows; calibrated on each half with dictionaries from the other, so never on texts they know.

    There is no model unless both halves have both classes.
    """
    rows = [r for r in rows if r[0].split()]
    halves = rows[0::2], rows[1::2]
    if any(len({y for _, y in half}) < 2 for half in halves):
        return None
    x, y = [], []
    for build, check in (halves, halves[::-1]):
        pair = dictionaries(build, settings)
        x += [features(pair.gains(windows(t, settings.window))) for t, _ in check]
        y += [float(v) for _, v in check]
    final = dictionaries(rows, settings)
    return Model(final.toxic, final.ordinary, settings, *calibrated(np.array(x), np.array(y)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", settings: Settings = Settings()) -> Model | None:
    """Train on a bounded sample: of each class the labelled rows with the smallest hashes of their ids.

    Only ids and labels are ordered; the texts of the sample meet in one task, at most ``most_toxic`` + ``most_ordinary``
    rows, and the driver receives the finished model. Rows without text or label are not used. Without rows of both classes
    there is no model.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").dropDuplicates(["id"])
    known = known.join(docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id")).distinct(), "id").withColumn("h", F.xxhash64("id"))
    chosen = [known.where(F.col("y") == y).orderBy("h", "id").limit(n) for y, n in ((1, settings.most_toxic), (0, settings.most_ordinary))]
    sample = materialise(chosen[0].union(chosen[1]), "sample")
    # at most 9000 ids, so broadcasting them is bounded
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").select("h", "id", "y", "text")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for batch in batches:
            got += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(3)), batch.column(2).to_pylist())
        got.sort(key=lambda r: r[:3])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit([r[2:] for r in got], settings))], pa.binary())], names=["model"])

    out = rows.repartition(1).mapInArrow(fitted, "model binary").collect()
    return pickle.loads(out[0].model) if out else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and a score from 0 to 1 for every text, higher for toxic ones; one row per input row.

    Every window of the whole text is compressed with both dictionaries. Null, empty and wordless texts have the score of
    a text that gains nothing from the toxic dictionary; without a model every score is 0. Repeated rows give repeated
    results; an empty table gives an empty one; columns of other names are not read.
    """
    if model is None:
        return docs.select(F.col(id_col), F.lit(0.0).alias("score"))
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(text: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        pair = Compressors(model.toxic, model.ordinary, model.settings.level)
        for batch in text:
            out = []
            for t in as_bytes(batch):
                parts = windows(t or b"", model.settings.window)
                out.append(model.score(pair.gains(parts)) if parts else model.prior())
            yield pa.array(out, pa.float64())

    return docs.select(F.col(id_col), scored(F.col(text_col)).alias("score"))
