"""Session settings and the shared scratch folder."""

import atexit
import math
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are written for. A skewed join is split even when the
# split costs one more shuffle; without the last line Spark leaves a hot key whole
# whenever an aggregation on the join key follows.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Shuffled bytes per partition to aim for before AQE merges small partitions.
PARTITION_BYTES = 128 << 20


def tuned(
    spark: SparkSession, shuffle_bytes: int | None = None, partition_bytes: int = PARTITION_BYTES
) -> SparkSession:
    """Apply the adaptive settings to a running session and return it.

    ``shuffle_bytes`` is about how much the heaviest shuffle of the next jobs weighs; call
    again before lighter ones. It sets how many partitions of ``partition_bytes`` a shuffle
    starts with: AQE merges small partitions, but does not split large ones unless they
    are skewed, so a large table needs many from the start.
    """
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        partitions = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")),
            math.ceil(shuffle_bytes / partition_bytes),
        )
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    return spark


def local_session(cores: str = "8", memory: str = "8g", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; settings come without ``spark.``"""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("innledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", _own_folder())
        # Keeps Spark from taking a Python stack trace for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(f"spark.{key}", value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def shared_folder(spark: SparkSession, name: str = "innledger") -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    It is deleted when the application ends. Where the setting is absent, a session that
    is one process gets a temporary folder; any other is refused, since a machine-local
    folder would lose data there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = _own_folder()
    folder = f"{configured.rstrip('/')}/{name}-{uuid.uuid4()}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends in a file."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="innledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
