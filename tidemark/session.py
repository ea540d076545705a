"""Shared scratch storage: where lineage is cut and where sink checks write."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Where the setting is missing a local session gets a temporary folder of its own; on a cluster, where
    executors don't share such a folder, that is an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[key]


def scratch_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A path under the scratch root that no earlier write has used; one that is kept outlives `scratch`."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if not kept and (written := _written.get()) is not None:
        written.append(path)
    return path


@contextmanager
def scratch() -> Iterator[None]:
    """Scratch tables that are made inside are removed at the end, after an error too.

    Frames that read them must have been written or collected by then. A folder on a file system that pyarrow
    doesn't reach is left in place, with a warning.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            discard(path)


def discard(path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    try:
        system, inside = FileSystem.from_uri(path)
        if system.get_file_info(inside).type is FileType.Directory:
            system.delete_dir(inside)
            return
    except (OSError, ValueError, NotImplementedError) as error:
        log.warning("scratch folder %s stays: %s", path, error)
        return
    log.warning("scratch folder %s is not to be found from the driver and may stay", path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage once as Parquet and continue from the written table.

    Used where a result is read several times (quantile passes, scoring): the table outlives
    lost executors and later passes read only the columns they need. `scratch` removes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
