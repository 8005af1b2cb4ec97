"""Shared helpers: where tables are kept, and how lineage is cut."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java, RE2 and Python pattern.
SPACE = r"[\x20\x09-\x0D]+"
#: bytes.translate table that lower-cases A-Z and nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


try:
    _LIBC = ctypes.CDLL("libc.so.6")
    # blocks under 32 MB come from the heap, whose free end is handed back by hand_back alone, not at every turn
    _LIBC.mallopt(-3, 32 << 20)
    _LIBC.mallopt(-1, 1 << 30)
except (OSError, AttributeError):  # another C library
    _LIBC = None
pa.set_memory_pool(pa.system_memory_pool())


def hand_back() -> None:
    """Python workers live on between tasks, beside a JVM: what one has freed goes back to the system at once."""
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


_KEPT: dict = {}


def kept(name: str, make):
    """What a worker process keeps between tasks, one thing at a time: the same until let_go."""
    if name not in _KEPT:
        let_go()
        _KEPT[name] = make()
    return _KEPT[name]


def let_go() -> None:
    """Workers go from one operator to the next: what another has kept there goes first."""
    if _KEPT:
        _KEPT.clear()
        hand_back()


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Numbers(dict):
    """Numbers of words, by first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where that is unset, a local master gets a new one; a cluster has no other folder that all can read."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        found = f"file://{tempfile.mkdtemp(prefix='terravane-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: later jobs neither repeat its work nor need the executors that did it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(column) -> F.Column:
    """crc32 of an id written as text, unsigned."""
    return F.crc32(column.cast("string").cast("binary"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
