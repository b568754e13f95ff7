"""Shared working folder for checkpoints and intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from hitledger.sources.catalog import remove_folder

_folders: list[tuple[str, str]] = []


def ensure_checkpoints(spark: SparkSession) -> str:
    """The folder the session names for checkpoints.

    Without one, a local session gets a temporary folder; on a cluster the
    executors could not share it, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if shared is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="hitledger-"))
    return shared or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate files, kept until `clear`.

    Frames are lazy: one that reads such files may be used after the next call.
    """
    path = f"{ensure_checkpoints(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _folders.append((spark.sparkContext.applicationId, path))
    return path


def scratch_database(spark: SparkSession, name: str) -> tuple[str, str]:
    """The name of a new database of this application, and where it is to lie.

    `clear` drops it, and the databases of its layers, `<name>_<layer>`.
    """
    location = scratch_path(spark, name)
    return f"hitledger_{name}_{uuid.uuid4().hex}", location


def clear(spark: SparkSession) -> None:
    """Drop the databases and folders that this application has made."""
    for row in spark.sql("SHOW DATABASES LIKE 'hitledger_*'").collect():
        place = spark.catalog.getDatabase(row[0]).locationUri
        if spark.sparkContext.applicationId in place:
            spark.sql(f"DROP DATABASE {row[0]} CASCADE")
    own = spark.sparkContext.applicationId
    for application, folder in _folders:
        if application == own:
            remove_folder(spark, folder)
    _folders[:] = [x for x in _folders if x[0] != own]
