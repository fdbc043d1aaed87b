"""Optimal length buckets: boundaries by dynamic programming over the global histogram, token-budget batches inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WORD = r"[^\x20\x09-\x0D]+"
# Rows numbered by one task; the number of shards of a bucket grows with its rows.
ROWS_PER_SHARD = 100_000


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` padded lengths with the least total padding; the largest length is always one.

    With lengths in ascending order, a bucket of the lengths j+1..i pads each of its rows to the i-th length. The table
    of least costs grows by one bucket at a time. Of equally good choices the one with the shorter last-but-one
    boundary is taken; more buckets than distinct lengths are not used.
    """
    if not lengths:
        return []
    size, n = np.array(lengths, np.int64), np.array(counts, np.int64)
    rows, tokens = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * size)])
    m = len(size)
    # cost of one bucket that ends at i and holds everything below
    best = size * rows[1:] - tokens[1:]
    choices = []
    for _ in range(1, min(buckets, m)):
        new, chosen = best.copy(), np.full(m, -1)
        for i in range(1, m):
            cost = best[:i] + size[i] * (rows[i + 1] - rows[1 : i + 1]) - (tokens[i + 1] - tokens[1 : i + 1])
            j = int(np.argmin(cost))
            if cost[j] < new[i]:
                new[i], chosen[i] = cost[j], j
        choices.append(chosen)
        best = new
    out, i = [int(size[-1])], m - 1
    for chosen in reversed(choices):
        if chosen[i] >= 0:
            i = int(chosen[i])
            out.append(int(size[i]))
    return out[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 16, longest: int = 4096, token_budget: int = 65536) -> DataFrame:
    """Batches of pieces of similar length: one row per piece of every document.

    Tokens are words. A text of more than ``longest`` tokens is cut into pieces of that length and a rest, so no token is
    lost and the histogram has at most ``longest`` + 1 entries, the only data that reach the driver. Columns: the id,
    piece, start_token, n_tokens, bucket, padded_length, batch, slot and padding. A batch of a bucket holds as many rows as
    fit the token budget at the padded length, one at least; only the last batch of a bucket may hold fewer.

    Null, empty and wordless texts are one piece of length 0. Every input row is packed, repeated ones and null ids too.
    Numbers inside a bucket come from counts per shard and a numbering within the shard, so no bucket passes through one
    task. Empty tables give empty ones; other columns are not read.
    """
    counted = docs.select(F.col(id_col).alias("id"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("total"))
    rows = materialise(counted.withColumn("row", F.monotonically_increasing_id()), "lengths")
    piece = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("total") / longest) - 1, F.lit(0)).cast("int"))).alias("piece")
    pieces = rows.select("id", "row", "total", piece).withColumn("n", F.least(F.lit(longest), F.col("total") - F.col("piece") * longest))
    histogram = sorted((r.n, r.c) for r in pieces.groupBy("n").agg(F.count("*").alias("c")).collect())
    bounds = boundaries([n for n, _ in histogram], [c for _, c in histogram], buckets) or [0]
    shards = 1 + sum(c for _, c in histogram) // ROWS_PER_SHARD
    ends = F.array(*[F.lit(b).cast("long") for b in bounds])
    placed = pieces.withColumn("bucket", F.size(F.filter(ends, lambda b: b < F.col("n"))))
    placed = placed.withColumn("padded", F.get(ends, F.col("bucket"))).withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    inside = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket", "shard").agg(F.count("*").alias("c"))
    offsets = offsets.select("bucket", "shard", F.coalesce(F.sum("c").over(inside), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("k", F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("row", "piece")) - 1).join(offsets, ["bucket", "shard"])
    rows_per_batch = F.greatest(F.floor(F.lit(token_budget) / F.greatest("padded", F.lit(1))), F.lit(1))
    place = F.col("offset") + F.col("k")
    return numbered.select(
        F.col("id").alias(id_col), F.col("piece").cast("long").alias("piece"), (F.col("piece") * longest).cast("long").alias("start_token"), F.col("n").alias("n_tokens"),
        F.col("bucket").cast("long").alias("bucket"), F.col("padded").alias("padded_length"), F.floor(place / rows_per_batch).alias("batch"),
        (place % rows_per_batch).alias("slot"), (F.col("padded") - F.col("n")).alias("padding"),
    )
