"""What the operators of this subpackage share: reading, staging, byte-level word rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import quoted
from tidegauge.session import scratch_dir


#: Bytes of a batch that goes to a Python worker.
BATCH_BYTES = 8 << 20
_Kept = TypeVar("_Kept")
_KEPT: dict[Hashable, object] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of our own; whatever else the table holds cannot clash."""
    return df.select(*[F.col(quoted(source)).alias(alias) for alias, source in columns.items()])


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there.

    The files survive the loss of any executor, and whatever reads the result twice
    does not compute it twice.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of a key written as text, modulo ``folds``; null keys have no fold."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def lower_ascii() -> bytes:
    """A byte table that lower-cases A-Z and keeps every other byte."""
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of bounded bytes; a smaller bound of the session stays.

    By rows alone, as long as Spark's default of 64 MB allows, a batch of long texts takes more
    memory than all else a worker holds.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)b?", spark.conf.get(name, "64m").lower()).groups()
    if not 0 < int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def kept(key: Hashable, make: Callable[[], _Kept]) -> _Kept:
    """What a worker keeps from one task to the next; one thing at a time.

    Workers outlive a stage: what the last one kept is let go when another asks.
    """
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Free what tasks of earlier stages kept in this worker."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """A shared folder as tasks reach it: local mounts, HDFS, S3, GCS and whatever else Arrow can open."""
    return pafs.FileSystem.from_uri(path)
