"""Session construction and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Broadcast is chosen by Spark from measured sizes only; nothing in this package hints one on
# data that grows. AQE splits skewed join partitions and coalesces small ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Staged tables repeat names, sheets and keys, which this codec packs into half the bytes of Spark's default.
STAGED_CODEC = ("compression", "zstd")

# A staged row takes 4 to 8 bytes, so that one split of Spark's default size would give a task more than ten million lines to hash or sort.
SPLIT_BYTES = 16 << 20


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def limit_splits(spark: SparkSession) -> None:
    """Splits of ``SPLIT_BYTES`` for a session that has no size of its own."""
    name = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(SPLIT_BYTES))


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()  # open blocks, the session's own setting
_releasing_lock = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside are removed when their action ends, those of a stage when it is written.

    Spark otherwise keeps them until the driver collects its garbage, which it seldom does on a cluster, and the shuffles of all stages lie
    on the disks together. Blocks may be nested and overlap in threads. For DataFrames that run once: one run again repeats its shuffles.
    """
    with _releasing_lock:
        blocks, own = _releasing.get(spark) or (0, spark.conf.get(_RELEASE, None))
        spark.conf.set(_RELEASE, "true")
        _releasing[spark] = (blocks + 1, own)
    try:
        yield
    finally:
        with _releasing_lock:
            blocks, own = _releasing.pop(spark)
            if blocks > 1:
                _releasing[spark] = (blocks - 1, own)
            elif own is None:
                spark.conf.unset(_RELEASE)
            else:
                spark.conf.set(_RELEASE, own)


def scratch_dir(spark: SparkSession) -> str:
    """The folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder, below its warehouse. On a cluster a
    machine-local folder would not be visible to other executors, so its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/ledgerloom-scratch"
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_scratch: dict[str, list[str]] = {}


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the scratch folder and read back, so that plans know its size and start from files.

    For small intermediate tables such as an index; ``drop_scratch`` removes those of the application.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    folder = f"{scratch_dir(spark)}/ledgerloom/{application}/scratch/{label}-{uuid.uuid4().hex}"
    df.write.option(*STAGED_CODEC).parquet(folder)
    _scratch.setdefault(application, []).append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_scratch(spark: SparkSession) -> None:
    for folder in _scratch.pop(spark.sparkContext.applicationId, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
