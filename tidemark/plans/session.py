"""Session settings that follow the size of the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024
PARTITION_BYTES = 128 * MIB
MAX_SPLIT_BYTES = 512 * MIB
MAX_PARTITIONS = 50_000
LARGE_INPUT_BYTES = 100 * 1024 * MIB


def partitions_for(input_bytes: int, cores: int = 1) -> int:
    """Shuffle partitions of about ``PARTITION_BYTES``, at least one per core.

    The cap keeps the number of shuffle blocks (map tasks times partitions) within
    what a driver can track; beyond it partitions grow and spill instead.
    """
    needed = -(-input_bytes // PARTITION_BYTES)
    return int(min(max(needed, cores, 1), MAX_PARTITIONS))


def split_bytes_for(input_bytes: int) -> int:
    """Scan split size: grows with the input so that map tasks stay below about 200,000."""
    return int(min(max(input_bytes // 200_000, PARTITION_BYTES), MAX_SPLIT_BYTES))


def prepare(spark: SparkSession, input_bytes: int, cores: int | None = None) -> SparkSession:
    """Settings for a job over about ``input_bytes``.

    Shuffles start with enough partitions for the whole input; adaptive execution
    merges small ones (to the advisory size, once the input is large) and splits
    the large ones of a skewed join.  Ledger times are UTC instants, and so is
    their text.
    """
    cores = cores or spark.sparkContext.defaultParallelism
    small = input_bytes < LARGE_INPUT_BYTES
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": str(small).lower(),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split_bytes_for(input_bytes)),
        "spark.sql.shuffle.partitions": str(partitions_for(input_bytes, cores)),
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark
