"""Secrets in text: known forms by pattern, others by sliding-window entropy over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

KINDS = ("assign", "access", "hex", "entropy")

# Fixed patterns of the known forms.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a longer run that starts earlier cannot be passed over: the run is maximal
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PIECE = re.compile(r"[^=]+")

# Character classes: pattern of a run, window length, least entropy in bits per character. A run of one class is judged by
# that class, and as part of a longer run of a wider class by that one too.
# A window of n characters has at most log2(n) bits, so the bars differ with the class and its alphabet.
CLASSES = (("digits", re.compile(r"[0-9]+"), 24, 2.75), ("hex", re.compile(r"[0-9a-fA-F]+"), 24, 3.1), ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.75))

# Strings of these forms are no secrets, whatever their entropy.
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # identifiers in five groups
    re.compile(r"[=_+/-]+"),  # rulers
    re.compile(r"[0-9]{1,19}(?:[_-]+[0-9]{1,19})*[_-]*"),  # numbers and dates
)
# Words, also joined by dashes and in paths; whether their letters are those of words is judged besides.
WORDS = re.compile(r"/?[A-Za-z]+(?:[-_/]+[A-Za-z]+)*[-_/]*")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
# Rounded shares of the letters a to z in European languages, in hundredths.
SHARES = (8.5, 1.5, 3.0, 4.2, 13.5, 1.4, 1.9, 3.2, 7.8, 0.4, 1.2, 4.6, 2.7, 8.0, 6.0, 2.2, 0.5, 6.8, 6.8, 7.2, 4.0, 1.6, 1.4, 0.3, 1.1, 0.6)
WEIGHTS = {chr(97 + i): math.log2(0.26 * share) for i, share in enumerate(SHARES)}


def wordy(string: str) -> bool:
    """Whether a string has the shape of words: parts of four letters on average, more like language than like drawn letters."""
    if not WORDS.fullmatch(string):
        return False
    letters = sum(c.isalpha() for c in string)
    # a single letter, over and over, is no key either
    drawn = len(set(string.lower())) > 2 and sum(WEIGHTS.get(c, 0.0) for c in string.lower()) < -0.2 * letters
    joined = len(re.findall("[A-Za-z]+", string))
    return not drawn and (len(PARTS.findall(string)) - joined) * 4 <= letters


def counting(digits: str) -> bool:
    """Whether the digits go up or down by the same step, as in 1234567890123."""
    return len({(ord(b) - ord(a)) % 10 for a, b in zip(digits, digits[1:])}) <= 1


def harmless(string: str) -> bool:
    return any(p.fullmatch(string) for p in ALLOW) or wordy(string)


def known_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known forms, leftmost and non-overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6] if ":" in text or "=" in text else []
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def hot_windows(string: str, size: int, least: float) -> list[tuple[int, int]]:
    """Unions of the windows of ``size`` characters whose Shannon entropy reaches ``least``.

    The counts move with the window: one character leaves, one enters, and the sum of c*log2(c) changes by the
    difference of two table values for each.
    """
    if len(string) < size:
        return []
    cost = [0.0] + [c * math.log2(c) for c in range(1, size + 1)]
    counts: dict[str, int] = {}
    total, spans, full = 0.0, [], math.log2(size)
    for i, ch in enumerate(string):
        c = counts.get(ch, 0)
        total += cost[c + 1] - cost[c]
        counts[ch] = c + 1
        if i >= size:
            old = string[i - size]
            c = counts[old]
            total += cost[c - 1] - cost[c]
            counts[old] = c - 1
        if i >= size - 1 and full - total / size >= least - 1e-9:
            start = i - size + 1
            if spans and start <= spans[-1][1]:
                spans[-1][1] = i + 1
            else:
                spans.append([start, i + 1])
    return [tuple(s) for s in spans]


def entropy_spans(text: str, allow: Iterable[str] = ()) -> list[tuple[int, int, str]]:
    """Spans of high entropy within candidate strings that no allow-list entry covers whole.

    A candidate is cut at ``=``, so that a name before a value is judged apart from it. In each piece that is not allowed the
    windows of each class slide over the longest runs of that class; the widest class also takes the candidate as a whole.
    Overlapping spans count as one.
    """
    out: list[tuple[int, int, str]] = []
    allowed = set(allow)
    for m in CANDIDATE.finditer(text):
        string = m.group()
        if string in allowed or harmless(string):
            continue
        pieces = [(p.start(), p.group()) for p in PIECE.finditer(string)]
        open_pieces = [(at, p) for at, p in pieces if p not in allowed and not harmless(p)]
        runs = [(at + r.start(), r.group(), k) for at, p in open_pieces for k in range(len(CLASSES) - 1) for r in CLASSES[k][1].finditer(p)]
        # a run of digits is no hexadecimal one
        runs = [(at, run, k) for at, run, k in runs if len(run) >= CLASSES[k][2] and (not counting(run) if run.isdigit() else True) and (k == 0 or not run.isdigit())]
        # names before a value count with it, unless the value is allowed
        if open_pieces and open_pieces[-1] == pieces[-1] and not CLASSES[-2][1].fullmatch(string):
            runs.append((0, string, len(CLASSES) - 1))
        spans = sorted((m.start() + at + a, m.start() + at + b) for at, run, k in runs for a, b in hot_windows(run, *CLASSES[k][2:]))
        last = len(out)
        for a, b in spans:
            if len(out) > last and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]), "entropy")
            else:
                out.append((a, b, "entropy"))
    return out


def all_spans(text: str, allow: Iterable[str] = ()) -> list[tuple[int, int, str]]:
    """Known forms, and entropy spans that no known form covers; by start, then kind as listed, then end."""
    known = known_spans(text)
    added = [s for s in entropy_spans(text, allow) if not any(a <= s[0] and s[1] <= b for a, b, _ in known)]
    return sorted(known + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """The text with every span replaced by ``mask``; overlapping spans count as one."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", allow: tuple[str, ...] = ()) -> DataFrame:
    """The same rows and columns with the secrets in ``text_col`` masked; null and empty texts stay as they are."""

    bounded_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def masked(text: pa.Array) -> pa.Array:
        return pa.array([t and redacted(t, all_spans(t, allow), mask) for t in text.to_pylist()], type=pa.string())

    return docs.withColumn(text_col, masked(F.col(text_col)))


RESULT = pa.struct(
    [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_entropy", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ()) -> DataFrame:
    """Spans of secrets in every text, one row per input row.

    Offsets are code points, ends exclusive. A null text counts as empty: no spans, and the digest of the empty
    string. ``allow`` names candidate strings that are never reported by entropy; known forms always are.
    Repeated rows give repeated results; an empty table gives an empty one; other columns are not read.
    """

    bounded_batches(docs.sparkSession)

    def found(text: str | None) -> dict:
        spans = all_spans(text or "", allow)
        n = {k: sum(1 for s in spans if s[2] == k) for k in KINDS}
        base = joined(s for s in spans if s[2] != "entropy")
        return {f"n_{k}": v for k, v in n.items()} | {"base_sha256": hashlib.sha256(base.encode()).hexdigest(), "spans": joined(spans)}

    @F.arrow_udf("n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")
    def scanned(text: pa.Array) -> pa.Array:
        return pa.array([found(t) for t in text.to_pylist()], type=RESULT)

    return docs.select(F.col(id_col), scanned(F.col(text_col)).alias("_found")).select(id_col, "_found.*")
