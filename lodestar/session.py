"""Session construction and shared-storage staging.

Library code never invents a machine-local scratch folder: intermediate
tables that must survive executor loss are written under the folder the
cluster names in ``spark.checkpoint.dir``.  Only tests and local benches set
that folder themselves (and only when it is unset).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a cluster and locally: AQE re-plans joins from
# measured shuffle sizes (its broadcast conversion is the size check for
# small derived sides), splits skewed partitions, and coalesces tiny ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # post-shuffle partitions near 128 MB; scan splits of 128 MB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "lodestar",
    shuffle_partitions: int = 8,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Local/test session. On a cluster use the cluster's session and
    ``configure(spark)`` instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable SQL options to an existing session, except
    those that its own configuration names."""
    own = spark.sparkContext.getConf()
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and not own.contains(k):
            spark.conf.set(k, v)
    return spark


def ensure_local_checkpoint_dir(spark: SparkSession, root: str = "/tmp") -> str:
    """For tests and local benches only: name a checkpoint folder when the
    session has none.  A cluster session already carries one."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    import tempfile

    path = tempfile.mkdtemp(prefix="lodestar-ckpt-", dir=root)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged intermediates.

    Order: ``spark.checkpoint.dir`` from the session, then the folder already
    registered on the SparkContext, then a sub-folder of the SQL warehouse
    (shared storage on a cluster, like the tables themselves)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            path = jdir.get()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        wh = spark.conf.get("spark.sql.warehouse.dir")
        path = wh.rstrip("/") + "/_lodestar_checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


# Folders of the open scopes, innermost last; ``stage`` writes into that one.
_SCOPES: list[str] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A scope that owns what is staged in it.  Its folder is removed when the
    block ends, so write the result inside the block::

        with staging(spark):
            query(spark, tables).write.parquet(target)

    Scopes nest; jobs of one scope may run in threads, but scopes of unrelated
    jobs must not overlap."""
    path = f"{checkpoint_root(spark).rstrip('/')}/lodestar/scope-{uuid.uuid4().hex}"
    _SCOPES.append(path)
    try:
        yield path
    finally:
        _SCOPES.remove(path)
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the checkpoint root (in the open scope's
    folder, if there is one) and read it back.

    Cuts lineage (a lost executor re-reads the written files instead of
    recomputing a shuffle chain) and pins non-deterministic columns such as
    partition ids.  One write pass, columnar, with pushdown on re-read."""
    spark = df.sparkSession
    root = _SCOPES[-1] if _SCOPES else f"{checkpoint_root(spark).rstrip('/')}/lodestar"
    path = f"{root}/{tag}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# A derived side (group statistics) is broadcast only when a count of its
# staged rows proves it small; beyond the bound the join stays a shuffle join.
BROADCAST_ROWS_MAX = 1_000_000
BROADCAST_BYTES_MAX = 32 * 1024 * 1024


def stage_bounded(df: DataFrame, tag: str = "small", max_rows: int = BROADCAST_ROWS_MAX) -> DataFrame:
    """Stage ``df`` and mark it for broadcast if it has at most ``max_rows``
    rows and its files at most ``BROADCAST_BYTES_MAX`` bytes.  The hint spares the large side the shuffle that a size-based
    switch by AQE would only decide after that shuffle has been written."""
    from pyspark.sql import functions as F

    staged = stage(df, tag)
    small = file_bytes(staged) <= BROADCAST_BYTES_MAX and staged.count() <= max_rows
    return F.broadcast(staged) if small else staged


def file_bytes(staged: DataFrame) -> int:
    """Bytes of the files that a staged table is read from."""
    return int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
