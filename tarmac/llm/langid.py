"""Language shares of a text: a mixture over n-gram models fitted by expectation-maximisation, its languages chosen by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, materialise

SLOTS = 1 << 16  # n-grams share so many counters, so a language's model takes a fixed 256 KB
UNKNOWN = "und"

# Bytes as the models see them: A-Z lower-cased, other ASCII that is no letter as a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams(text: bytes, size: int) -> np.ndarray:
    """The slot of each run of ``size`` bytes; runs of blanks count as one, and blanks frame and fill up the text."""
    folded = b" " + b" ".join(text.translate(_FOLD).split()) + b" "
    b = np.frombuffer(folded.ljust(size), np.uint8).astype(np.uint32)
    code = np.zeros(len(b) - size + 1, np.uint32)
    for i in range(size):
        code = code * np.uint32(257) + b[i : len(b) - size + 1 + i]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(ch.isalpha() for ch in text[:64]) or any(ch.isalpha() for ch in text)


def count_grams(docs: DataFrame, text_col: str, lang_col: str, size: int) -> DataFrame:
    """(lang, slot, n) over all given rows: summed inside each task first, then by Spark."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            waiting: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist()):
                waiting.setdefault(lang, []).append(grams(text, size))
            for lang, parts in waiting.items():
                n = np.bincount(np.concatenate(parts), minlength=SLOTS)
                sums[lang] = sums[lang] + n if lang in sums else n
        for lang, n in sums.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(n[slot])], names=["lang", "slot", "n"])

    known = docs.select(text_col, F.col(lang_col).cast("string")).where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    return known.mapInArrow(counted, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """Log-likelihood of each n-gram slot under each language, a matrix of fixed height."""

    def __init__(self, langs: list[str], probabilities: np.ndarray, size: int):
        self.langs, self.probabilities, self.size = langs, probabilities, size


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = 4, smoothing: float = 0.5) -> Model:
    """Count n-grams of all rows with a text and a language.

    The driver receives the sums only: at most SLOTS numbers for each distinct language, whatever the size of the
    input. With no such row the model has no language, and every text is ``und``.
    """
    bounded_batches(docs.sparkSession)
    counts = materialise(count_grams(docs, text_col, lang_col, size), "grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    sums = np.full((SLOTS, len(langs)), smoothing)
    for i, lang in enumerate(langs):
        got = counts.where(F.col("lang") == lang).select("slot", "n").toArrow()
        sums[got["slot"].to_numpy(), i] += got["n"].to_numpy()
    return Model(langs, (sums / sums.sum(axis=0)).astype(np.float32) if langs else sums.astype(np.float32), size)


def shares(p: np.ndarray, weights: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Mixture shares of the columns of ``p`` by expectation-maximisation, and the log-likelihood reached."""
    total, pi = weights.sum(), np.full(p.shape[1], 1 / p.shape[1], np.float32)
    if p.shape[1] > 1:
        for _ in range(rounds):
            new = pi * ((weights / (p @ pi)) @ p) / total
            step = np.abs(new - pi).max()
            pi = new
            if step < 1e-3:
                break
    return pi, float(weights @ np.log(p @ pi))


def detect(model: Model, slots: np.ndarray, rounds: int, penalty: float) -> dict:
    """Fit all languages, then keep the largest shares as far as the penalised likelihood grows.

    Each language beyond the first costs ``penalty * log(n)`` of log-likelihood, n being the number of n-grams. Sets are
    tried in order of the shares fitted with all languages, smallest set first, until adding one no longer pays. Equal
    shares are taken in the order of the language names.
    """
    # equal n-grams are gathered first, so a long text costs no more than the number of slots
    slots, weights = np.unique(slots, return_counts=True)
    weights, n = weights.astype(np.float32), int(weights.sum())
    p = model.probabilities[slots]
    pi, _ = shares(p, weights, rounds)
    order = np.argsort(-pi, kind="stable")
    best, chosen, at = -np.inf, np.ones(1), order[:1]
    for m in range(1, len(order) + 1):
        own, reached = shares(p[:, order[:m]], weights, rounds)
        value = reached - penalty * (m - 1) * np.log(max(n, 2))
        if value <= best:
            break
        best, chosen, at = value, own, order[:m]
    top = int(np.argmax(chosen))
    total = float(chosen.sum())
    found = sorted(((float(chosen[i]) / total, model.langs[at[i]]) for i in range(len(at))), key=lambda x: (-x[0], x[1]))
    return {"lang_pred": model.langs[at[top]], "score": min(1.0, float(chosen[top]) / total), "langs": [x[1] for x in found], "shares": [x[0] for x in found]}


RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))])


def detector(spark, model: Model, rounds: int = 30, penalty: float = 1.0):
    """A column function from text to struct(lang_pred, score, langs, shares).

    ``und`` with score 0 and no languages for null texts, texts without a letter, and a model without languages.
    The model is broadcast; its size is SLOTS floats a language.
    """
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def one(text: str | None) -> dict:
        model = shared.value
        if text is None or not model.langs or not has_letter(text):
            return {"lang_pred": UNKNOWN, "score": 0.0, "langs": [], "shares": []}
        return detect(model, grams(text.encode(), model.size), rounds, penalty)

    @F.arrow_udf("lang_pred string, score double, langs array<string>, shares array<double>")
    def detected(text: pa.Array) -> pa.Array:
        return pa.array([one(t.as_py()) for t in text], type=RESULT)

    return detected


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", rounds: int = 30, penalty: float = 1.0) -> DataFrame:
    """Language shares of every text, one row per input row: the id, lang_pred, score (share of lang_pred), langs and shares.

    Only the text is an input. Repeated rows give repeated results; an empty table gives an empty one; columns of
    other names are not read.
    """
    out = docs.select(F.col(id_col), detector(docs.sparkSession, model, rounds, penalty)(F.col(text_col)).alias("_found"))
    return out.select(id_col, "_found.*")
