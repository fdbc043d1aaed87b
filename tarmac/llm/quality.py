"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much text is rejected."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches

# Phrases of navigation and legal furniture, in lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "accept cookies", "use of cookies",
    "sign in", "log in to", "subscribe to our newsletter", "enable javascript", "javascript is disabled", "click here", "read more",
    "share on facebook", "share on twitter", "follow us on", "back to top", "skip to content", "lorem ipsum",
    "licensed under", "is licensed under the", "released under the mit license",
)
# Characters that end a sentence, those that may close it, and those that part links of a menu.
ENDS, CLOSERS, SEPARATORS, MARKS = ".!?…。！？:;", "\"'”’»)\\]", "|>»·•/\\-", "!?#*$%&"

_END = re.compile(f"[{ENDS}][{CLOSERS}]*$")
_PARTS = [c.encode() for c in "|>»·•/-"]
_SEPARATOR = re.compile(f"^[{SEPARATORS}]+$")
_MARKED = {(a + b).encode() for a in MARKS for b in MARKS}
_BOILERPLATE = re.compile(b"|".join(re.escape(p.encode()) for p in BOILERPLATE))

# Shares of a line's words, in hundredths, above which the navigation and the punctuation rule fail it.
MOST_SEPARATORS, MOST_MARKED = 20, 50

_WHITE, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"


def line_passes(line: bytes, tokens: list[bytes]) -> bool:
    """Punctuation, navigation and boilerplate rules for a line that has words and has not occurred before.

    A line passes if it ends as a sentence does, if at most a fifth of its words are separators, if at most half of
    its words end in two or more marks, and if it holds no boilerplate phrase.
    """
    if not _END.search(tokens[-1].decode()):
        return False
    n = len(tokens)
    if any(x in line for x in _PARTS) and 100 * sum(1 for w in tokens if _SEPARATOR.match(w.decode())) > MOST_SEPARATORS * n:
        return False
    if 100 * sum(1 for w in tokens if w[-2:] in _MARKED) > MOST_MARKED * n:
        return False
    return not _BOILERPLATE.search(line.lower())


def repeated_words(tokens: list[bytes], size: int) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    n = len(tokens)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.int64, n)
    if len(ids) == n:
        return 0
    # number the windows exactly, a word at a time
    keys = codes[: n - size + 1]
    for i in range(1, size):
        pairs = keys * len(ids) + codes[i : n - size + 1 + i]
        # the pair number stays below 2**63: both factors are at most the number of words
        keys = np.unique(pairs, return_inverse=True)[1]
        if keys.max() + 1 == len(keys):  # no run of this length repeats, so no longer one does
            return 0
    found = np.bincount(keys)[keys] > 1
    covered = np.zeros(n, bool)
    for i in range(size):
        covered[i : n - size + 1 + i] |= found
    return int(covered.sum())


def judge(text: bytes | None, window: int, least_kept: int, with_text: bool) -> dict:
    """Counts and the verdict for one text; null counts as a text without words."""
    text = text or b""
    tokens = text.split()
    n = len(tokens)
    letters = text.translate(None, _WHITE)
    seen, kept_lines, n_dup, n_failed, kept_bytes = set(), [], 0, 0, 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        if line in seen:
            n_dup += 1
            n_failed += 1
            continue
        seen.add(line)
        if line_passes(line, own):
            kept_bytes += sum(map(len, own))
            kept_lines.append(line)
        else:
            n_failed += 1
    n_repeat = repeated_words(tokens, window)
    base_failed = n < 10 or 100 * n_repeat > 20 * n
    return {
        "n_words": n,
        "word_chars": len(letters.decode()),
        "n_symbols": len(text) - len(text.translate(None, _SYMBOLS)),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "n_failed_lines": n_failed,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * kept_bytes >= least_kept * len(letters),
        "clean_text": b"\n".join(kept_lines).decode() if with_text else None,
    }


RESULT = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("clean_text", pa.string())]
)
RESULT_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_failed_lines long, "
    "base_failed boolean, kept boolean, clean_text string"
)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 5, least_kept: int = 50, with_text: bool = True) -> DataFrame:
    """Judge the lines of every text; one row per input row, in any order.

    A line without words is neither kept nor failed. A line equal to an earlier one fails; the others go through
    ``line_passes``. ``kept`` is false for fewer than ten words, for more than a fifth of the words inside repeated
    windows of ``window`` words, and when less than ``least_kept`` hundredths of the word bytes are on passing lines.

    Null and empty texts have zero counts and are not kept. Repeated rows give repeated results. An empty table gives
    an empty one. Other columns are not read, so their names cannot clash. ``clean_text`` holds the passing lines
    (null unless ``with_text``).
    """

    bounded_batches(docs.sparkSession)

    @F.arrow_udf(RESULT_DDL)
    def judged(text: pa.Array) -> pa.Array:
        return pa.array([judge(t, window, least_kept, with_text) for t in as_bytes(text)], type=RESULT)

    out = docs.select(F.col(id_col), judged(F.col(text_col)).alias("_judged"))
    return out.select(id_col, *[F.col(f"_judged.{f.name}") for f in RESULT if with_text or f.name != "clean_text"])
