"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split into advisory-size pieces even when that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on (all can be changed on a live session)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarmac")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        # a few megabytes per stage would otherwise end up in one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        # test facts are smaller than the default threshold and must not be taken for a dimension
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
    )
    for key, value in {**RUNTIME_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    A private temporary folder is used only by a local master that names none; a cluster without the
    setting is an error, since a folder of one machine would be lost with it.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc.getCheckpointDir():
        # the context appends a folder of its own to what was set
        base = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tarmac-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


_PATHS: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; ``release`` removes it."""
    _PATHS.append(f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _PATHS[-1]


def release(spark: SparkSession) -> int:
    """Delete all stages that this process has stored; call it when their results have been written. Returns their number."""
    done, hadoop = 0, spark.sparkContext._jsc.hadoopConfiguration()
    while _PATHS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_PATHS.pop())
        done += bool(path.getFileSystem(hadoop).delete(path, True))
    return done


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage: write a table into the shared folder and read it back.

    Later stages see stored values (ids and floating sums no longer change between uses), column pruning
    and true sizes, and a lost executor costs a re-read instead of a re-computation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
