"""The shared folder in which jobs keep written tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Temporary folders of local sessions, by application.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster other machines could not read it.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tablewharf-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for one run; nothing is created or removed."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
