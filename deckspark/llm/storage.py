"""Files in the shared folder, from the driver and from tasks alike.

Tables go through Spark's own writers.  Formats Spark has no writer for
(Arrow streams, WARC) are written by tasks under a folder of
``spark.checkpoint.dir`` through Arrow's file systems, so the folder may be
a shared mount or an object store.  A task writes to a name of its own and
returns it as a row: only files named in the committed manifest table exist
for readers, so a retried or speculative attempt leaves nothing but an
unreferenced file.
"""

from __future__ import annotations

import ctypes
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, cut_lineage

__all__ = ["cut_lineage", "shared_folder", "file_system", "own_file", "held", "release", "spread"]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder URI below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    if "://" not in base:
        base = "file://" + os.path.abspath(base[len("file:"):] if base.startswith("file:") else base)
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def file_system(uri: str):
    """(file system, path) of a URI, usable on the driver and in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def own_file(folder: str, suffix: str) -> tuple:
    """(file system, path, URI) of a new file no other attempt can write."""
    name = f"{uuid.uuid4().hex}{suffix}"
    filesystem, path = file_system(folder)
    filesystem.create_dir(path, recursive=True)
    return filesystem, f"{path}/{name}", f"{folder}/{name}"


_HELD: dict = {}


def held(key, make):
    """In a worker process, the object of ``key``, kept for its next tasks.
    Only that of the last key asked for is kept, so the memos of one operator
    do not weigh on the stages of the next."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Frees what a worker process keeps.  The tasks of an operator that
    keeps nothing begin with it: a worker serves the stages of many.  The C
    library keeps freed memory unless asked to return it."""
    if _HELD:
        _HELD.clear()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def spread(df: DataFrame, *keys) -> DataFrame:
    """One Python task per shuffle partition instead of AQE's merged ones:
    for stages whose work per row is heavy although the rows are few."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
