"""Batch and streaming sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite; with partition columns only the partitions present in ``df`` are replaced, so a day can be re-run.

    Rows are gathered by partition value and rebalanced: a small partition becomes one file, a large one is
    split by size over many tasks.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        balanced = df.hint("rebalance", *partition_by)
        writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_daily(df: DataFrame, parquet_path: str, csv_path: str) -> DataFrame:
    """Both formats of one result, computed once: the CSV copy is derived from the written Parquet."""
    write_parquet(df, parquet_path)
    stored = df.sparkSession.read.schema(df.schema).parquet(parquet_path)
    write_csv(stored, csv_path)
    return stored


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 16, batch: int = 10_000) -> None:
    """Append to a metrics table over at most ``connections`` connections."""
    df.write.option("batchsize", batch).option("numPartitions", connections).jdbc(
        url, table, mode="append", properties=dict(properties)
    )


def write_json_report(df: DataFrame, path: str, compression: str | None = None) -> None:
    """JSON lines; a compressed file is one split when it is read, so it stays as large as what one task wrote."""
    df.write.mode("overwrite").json(path, compression=compression)


def keyed_json(df: DataFrame, key: str, topic: Column | str | None = None) -> DataFrame:
    """``key, value[, topic]`` rows for a topic sink; a topic column routes every row by itself."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    out = [F.col(key).cast("string").alias("key"), value]
    if topic is not None:
        out.append((F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    return df.select(*out)


def topic_sink(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None):
    """Start a stream into topics (needs the connector package on the class path)."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def run_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """Run a stream over everything available into a file sink (exactly once), and read the sink back."""
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)
