"""Where intermediate tables go: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RECORDS: list[list[DataFrame]] = []


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/catalog_sync/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame several outputs share and read it back: computed once, lineage cut, each
    reader prunes to the columns it needs, and a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    for frames in _RECORDS:
        frames.append(back)
    return back


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The frames staged within, for a later ``discard``."""
    frames: list[DataFrame] = []
    _RECORDS.append(frames)
    try:
        yield frames
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not frames]


def discard(*frames: DataFrame) -> None:
    """Delete staged frames that nothing reads any more: what was made of them is staged itself."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
