"""Session settings for large runs; pass them when the session is built."""

from __future__ import annotations

TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def run_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings sized by the bytes of the largest shuffle and the cores at hand.

    Adaptive execution merges small partitions, so the number is chosen for the
    largest table and does no harm to the small ones.
    """
    partitions = max(cores, -(-shuffle_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        # The JVM does not compile methods above this size. Wide projections
        # beyond it are split into smaller methods instead of being interpreted.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Recording the Python line of every column expression doubles the time
        # it takes to build the plan of a wide table.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.scheduler.mode": "FAIR",
    }
