"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at 100 TB as much as on local[8]: AQE re-plans joins from
# measured stage sizes (that is the size check behind every automatic broadcast),
# splits skewed partitions and coalesces tiny ones.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}

#: Stage tables are written once and read a few times: the smaller codec.
STAGE_CODEC = "zstd"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "histmill", checkpoint_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a cluster the
    submitter supplies both, and ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("HISTMILL_DRIVER_MEM", "16g"))
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of files that a join may broadcast before its rows are counted.
UNMEASURED_BROADCAST = 256 * 1024
_UNITS = {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]?)b?\s*", size.lower()).groups()
    return int(number) << _UNITS[unit]


def broadcast_by_measure(spark: SparkSession) -> None:
    """From now on joins broadcast a side by the measured size of its rows.

    Before a query runs Spark knows a scan only by the size of its files, and keys that are encoded
    and compressed there take up to a hundred times as much on the driver, which builds every
    broadcast. Such an estimate now counts up to ``UNMEASURED_BROADCAST`` only; for a larger side
    the threshold of the session decides when its shuffle has been measured (AQE)."""
    static, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(static)
    if _bytes(threshold) > UNMEASURED_BROADCAST:
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, threshold)
        spark.conf.set(static, str(UNMEASURED_BROADCAST))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only a local-mode session without that setting (tests) gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="histmill-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def stage(df):
    """Write an intermediate that later steps read several times (a stage table of the
    original scripts: clean catalog, users, import scope, link table) as a parquet table
    below the reliable checkpoint folder and return it. Later plans scan it, with column
    pruning and pushed filters, instead of re-deriving it from the base tables; the folder
    is shared, so the table survives executor loss."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=STAGE_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_as_dealt(df, key: str, buckets: int, order=()):
    """Write ``df``, each of whose tasks holds one value of ``key``, as a stage table bucketed by
    ``key`` and sorted by the columns ``order``: windows and groupings on ``key`` read it without
    a shuffle. Its name is dropped at once, the files stay."""
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", STAGE_CODEC).bucketBy(buckets, key)
    (writer.sortBy(*order) if order else writer).option(
        "path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name)
    out = spark.table(name)
    out._table_name = name
    out.schema  # resolved before its name goes
    forget_bucketed(out)
    return out


def stage_bucketed(df, key: str, buckets: int | None = None):
    """Write ``df`` as a table below the checkpoint folder, bucketed and sorted by ``key``: joins
    and groupings on that key, however many, read it without a shuffle. ``buckets`` defaults to
    the session's shuffle partitions, so that shuffled sides lie alike."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stage_{uuid.uuid4().hex}"
    (df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key)
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    out = spark.table(name)
    out._table_name = name
    return out


def forget_bucketed(*tables) -> None:
    """Drop the names of staged bucketed tables that no later plan reads; their files stay."""
    for df in tables:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._table_name}")
