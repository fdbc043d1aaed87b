"""Tumbling windows over samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_stats(
    samples: DataFrame, features: Sequence[str], ts: str = "event_timestamp", length: str = "7 days", entity: str = "aircraft_msn",
    flight: str = "flight_id", delay: str = "1 day",
) -> DataFrame:
    """Means per entity and window (windows start at the epoch); a stream closes a window once ``delay`` has passed it."""
    source = samples.withWatermark(ts, delay) if samples.isStreaming else samples
    stats = source.groupBy(F.window(ts, length), entity).agg(*[F.avg(c).alias(f"avg_{c}") for c in features], F.count(flight).alias("data_points"))
    return stats.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), entity, *[f"avg_{c}" for c in features], "data_points")
