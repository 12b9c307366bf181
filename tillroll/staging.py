"""Tables written once and read many times.

A job that reads an expensive intermediate more than once writes it to the
session's shared folder and continues from the written table. That cuts the
lineage, survives lost executors, and the readers still get column pruning and
filter pushdown.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillroll.session import shared_dir

_stages: dict[tuple[str, str, str], tuple[tuple, str, StructType]] = {}

# Stored bytes of input to a task, some 700,000 lines; and the partitions the driver can keep track of.
SHARE = 16 << 20
MOST = 10_000
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_LARGEST = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
_spreading = threading.RLock()


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tillroll/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_home(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; by default with the session's compression."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identity(spark: SparkSession, *paths: str) -> tuple:
    """What changes when a file under ``paths`` does: a digest of all names, sizes and times. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    mark = F.xxhash64("path", "length", "modificationTime")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(mark), F.max("modificationTime").cast("string")).first())


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def spread(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside have partitions, of input and shuffle, that grow with the ``size`` of their input in bytes.

    So what a task holds stays the same, however few partitions the session names; it is its settings that are
    changed, where they ask for larger tasks, and put back. One thread at a time is inside.
    """
    parts = min(MOST, -(-(size or 0) // SHARE))
    with _spreading:
        wanted = {}
        if int(spark.conf.get("spark.sql.shuffle.partitions")) < parts:
            wanted["spark.sql.shuffle.partitions"] = parts
        if int(spark.conf.get(_FIRST, None) or parts) < parts:
            wanted[_FIRST] = parts
        if parts > 1:
            wanted |= {key: SHARE for key in _LARGEST if _bytes(spark.conf.get(key)) > SHARE}
        now = {key: spark.conf.get(key, None) for key in wanted}  # None: not set
        try:
            for key, value in wanted.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in now.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage(spark: SparkSession, source: str, label: str, build: Callable[[], DataFrame], inputs: list[str] | None = None) -> DataFrame:
    """A table derived from ``source``, built by the first job of the application that asks for it.

    It is built anew when a file of ``inputs`` (by default: of ``source``) has changed since. Their size sets the
    partitions it is built with.
    """
    key = (spark.sparkContext.applicationId, source, label)
    now = identity(spark, *(inputs or [source]))
    if key in _stages and _stages[key][0] == now:
        _, path, schema = _stages[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # the folder was emptied in between
                raise
    path = fresh_path(spark, label)
    with spread(spark, now[1]):
        df = build()
        df.write.parquet(path, compression="zstd")
    _stages[key] = (now, path, df.schema)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete all tables this application wrote. Results still unread become unreadable."""
    home = spark._jvm.org.apache.hadoop.fs.Path(_home(spark))
    home.getFileSystem(spark._jsc.hadoopConfiguration()).delete(home, True)
    application = spark.sparkContext.applicationId
    for key in [k for k in _stages if k[0] == application]:
        del _stages[key]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written inside, all of them, at the end."""
    try:
        yield
    finally:
        discard(spark)
