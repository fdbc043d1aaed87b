"""Fill-in-middle transformation: an indexable skip list over the units of a text finds both cuts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mix

# The marks of prefix, suffix and middle, and how many units a link of one lane spans in the lane below, on average.
MARKS = ("<P>", "<S>", "<M>")
SPAN = 4


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit: a word with the white space before it, or the white space at the end of the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64)
    word = (points != 0x20) & ((points < 0x09) | (points > 0x0D))
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    if not word[-1]:
        ends = np.append(ends, len(points))
    return np.diff(ends, prepend=0)


class SkipList:
    """Units in order, with express lanes whose links carry two widths: units and code points.

    Lane 0 links every unit. A unit also starts a link of the next lane if its coin, a hash of its place, says so, one time in ``SPAN``;
    the head starts one in every lane. ``down`` names a link's own start in the lane below.
    """

    def __init__(self, widths: np.ndarray):
        self.size, self.points = len(widths), int(widths.sum())
        at = np.concatenate([[0], np.cumsum(widths)])
        starts = np.arange(self.size)
        height = np.zeros(self.size, np.int64)
        coin = mix(np.arange(self.size, dtype=np.uint64) + np.uint64(1))
        tossed = coin % np.uint64(SPAN) == 0
        while tossed.any():
            height[tossed] += 1
            coin = coin // np.uint64(SPAN)
            tossed &= coin % np.uint64(SPAN) == 0
        if self.size:
            height[0] = height.max()
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        level, below = 0, None
        while len(starts):
            ends = np.append(starts[1:], self.size)
            down = starts if below is None else np.searchsorted(below, starts)
            self.lanes.append((ends - starts, at[ends] - at[starts], down))
            if len(starts) == 1:
                break
            level, below = level + 1, starts
            starts = starts[height[starts] >= level]

    def offset(self, rank: int) -> int:
        """Code points before the unit of this rank; ``rank`` may be the number of units."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        units = points = place = 0
        for wide, long, down in reversed(self.lanes):
            while place < len(wide) and units + wide[place] <= rank:
                units += int(wide[place])
                points += int(long[place])
                place += 1
            if units == rank:
                return points
            place = int(down[place])
        return points


def draws(seed: int, id_col: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


CUT_DDL = "n long, first long, second long"
CUT = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80, marks: Sequence[str] = MARKS
) -> DataFrame:
    """One row per document: the id, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text.

    Two cuts, drawn from the id, part the units into prefix, middle and suffix. ``percent`` of the documents are rearranged, of
    these ``spm_percent`` with the suffix first (``spm``), the others with the prefix first (``psm``). Texts that are empty or hold a mark stay
    ``plain``, so ``restored`` can rebuild every text.

    Null texts count as empty: no units, plain. Null ids draw like an empty id. Repeated rows give repeated results; rows with
    one id share their draws. A text is read whole; its lanes take some 40 bytes a unit. Empty tables give empty ones; other columns are
    not read, so their names cannot clash.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(CUT_DDL)
    def cuts(text: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for t, h1, h2 in zip(text, a.to_pylist(), b.to_pylist(), strict=True):
            units = SkipList(unit_widths(t.as_py()))
            low, high = sorted((h1 % (units.size + 1), h2 % (units.size + 1)))
            out.append({"n": units.size, "first": units.offset(low), "second": units.offset(high)})
        return pa.array(out, type=CUT)

    h = draws(seed, id_col)
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *[c.alias(f"_h{i}") for i, c in enumerate(h)])
    base = base.select("*", cuts("_text", "_h0", "_h1").alias("_cut"))
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains("_text", F.lit(m))
    plain = (F.col("_text") == "") | marked | (F.col("_h2") % 100 >= percent)
    form = F.when(plain, "plain").when(F.col("_h3") % 100 < spm_percent, "spm").otherwise("psm")
    base = base.withColumn("_form", form)
    first, second = F.col("_cut.first").cast("int"), F.col("_cut.second").cast("int")
    prefix, middle = F.substring("_text", F.lit(1), first), F.substring("_text", first + 1, second - first)
    suffix = F.substring("_text", second + 1, F.length("_text"))
    p, s, m = (F.lit(x) for x in marks)
    output = F.when(F.col("_form") == "plain", F.col("_text")).when(F.col("_form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    moved = F.col("_form") != "plain"
    return base.select(
        F.col("_id").alias(id_col), F.col("_cut.n").alias("n"), F.col("_form").alias("form"), F.when(moved, F.col("_cut.first")).alias("prefix_chars"),
        F.when(moved, F.col("_cut.second") - F.col("_cut.first")).alias("middle_chars"), output.alias("output"),
    )


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The exact text behind an output: marks occur in a rearranged text only where they were put."""
    parts = F.split(output, "|".join(r"\Q" + m + r"\E" for m in marks))
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(found: DataFrame, id_col: str = "doc_id", marks: Sequence[str] = MARKS) -> DataFrame:
    """SHA-256 of each output and of the text rebuilt from output and form."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        id_col, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"), marks)).alias("restored_sha256"),
    )
