"""Shared helpers: staged tables, words, global order, table access."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.session import ensure_checkpoint_dir

#: Characters that separate words and that are stripped from lines: space, \t \n \x0b \x0c \r.
SPACES = " \t\n\x0b\x0c\r"
#: A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col) -> Column:
    """Lower-case A-Z only; every other letter stays as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def word_count(col) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession, records: int = 500) -> None:
    """Bound the Arrow batches handed to Python workers, so that a run of very long
    texts does not have to fit in memory ten thousand rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))


@contextmanager
def arrow_batches(spark: SparkSession, records: int = 500, size: str = "16m") -> Iterator[None]:
    """Inside, batches handed to Python workers hold ``records`` rows and ``size`` bytes at most
    (or one row that is larger). For what is written inside; the session's own values return."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(records),
              "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table below the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (the folder is shared, so a lost executor
    loses nothing), but the copy is columnar: later plans prune columns and push filters.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later plan reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        drop_folder(df.sparkSession, path)


def give_back() -> None:
    """Return freed memory to the system: the driver outlives the training of a model."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def ensure_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
