"""Batch and streaming readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import let


def read_csv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Headered CSV under an explicit schema; the header names are checked against it."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: str, array_files: bool = False) -> DataFrame:
    """JSON lines, or files that hold one array each (``array_files``; such a file is one split)."""
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def read_documents(spark: SparkSession, path: str | list[str], schema: str, id_column: str = "_id") -> DataFrame:
    """A dumped document collection; the identifier, plain or ``{"$oid": ...}``, becomes a string."""
    ident = F.col(id_column).cast("string")
    inner = F.get_json_object(ident, "$['$oid']")
    return spark.read.schema(schema).json(path).withColumn(id_column, F.coalesce(inner, ident))


def read_partitioned(
    spark: SparkSession, root: str, schema: str, day: str | date, airlines: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """One day of an ``airline=/date=`` layout; only its folders are listed in the scan."""
    reader = spark.read.schema(f"{schema}, airline string, date date").format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(root).filter(F.col("date") == F.lit(str(day)).cast("date"))
    return df if airlines is None else df.filter(F.col("airline").isin(list(airlines)))


def route_by_columns(keys: Column, file_name: Column) -> Column:
    """Target table of a landed record from the columns it has and the file it came from."""
    has = lambda name: F.array_contains(keys, name)
    return (
        F.when(has("engine_1_temp"), "flight_data")
        .when(has("takeoffs"), "usage_cycles")
        .when(has("alert_code"), "alerts")
        .when(has("event_type") & file_name.contains("maintenance"), "maintenance_events")
        .when(file_name.contains("airline_data"), "airline_metadata")
        .when(file_name.contains("technical_bulletins"), "technical_bulletins")
        .when(file_name.contains("weather_data"), "weather_data")
        .otherwise("unknown")
    )


def read_routed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines of mixed content as ``(route, value)``, read once; parse each route with its own schema.

    The name a record is judged by includes the folder of its file, as Spark writes one dump as a folder.
    """
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    name = F.substring_index(F.input_file_name(), "/", -2)
    return spark.read.text(path).select(let(keys, lambda k: route_by_columns(k, name)).alias("route"), "value")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    predicates: Sequence[str] | None = None,
    column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 32,
) -> DataFrame:
    """A database table over many connections: split by a numeric/date ``column`` or by explicit ``predicates``.

    Later filters are pushed into the database by Spark.
    """
    reader = spark.read
    if predicates:
        return reader.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
    if column and bounds:
        return reader.jdbc(
            url, table, column=column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=dict(properties),
        )
    return reader.jdbc(url, table, properties=dict(properties))


def day_predicates(column: str, days: Sequence[date]) -> list[str]:
    """One half-open range per pair of neighbouring days; rows before the first and from the last on are not read."""
    return [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(days, days[1:])]


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON lines as a stream of ``value``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest", group: str | None = None) -> DataFrame:
    """A topic as a stream of ``key, value, timestamp`` text (needs the connector package on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), F.col("timestamp").alias("arrival")
    )
