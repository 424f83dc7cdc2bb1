"""Tables written once in the cluster's shared folder, so that later steps start from files.

A written table cuts the lineage: a lost executor costs the tasks it ran, never an earlier step,
and row numbers or partition numbers that were assigned before the write stay what they were.

A result may still read its staged tables when its caller gets it, so only the caller knows when they can go:
``with temporary(spark): op(...).write...`` removes every folder that was staged inside the block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import scratch_dir

TASK_BYTES = 64 << 20  # of staged data in one task
_open: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{scratch_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(folder)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def partitions_for(spark: SparkSession, size: int) -> int:
    """How many partitions ``size`` bytes are dealt to: by the data, and at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores appended until no column of ``df`` has it, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes the folders that are staged inside the block when it ends."""
    _open.append([])
    try:
        yield
    finally:
        for folder in _open.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
