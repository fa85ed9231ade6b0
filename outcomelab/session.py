"""Session construction and the shared checkpoint folder.

Cluster jobs read ``spark.checkpoint.dir`` from the session: it must name a
shared, reliable folder (HDFS / object store).  Only a local-mode session
(tests, benchmarks) gets a private folder created here when it is unset.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; cluster deployments pass their own
# sizes (shuffle partitions, maxPartitionBytes) through ``extra``.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "outcomelab", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None
    except Exception:  # Spark Connect: no SparkContext on the client
        return False


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one only
    for local-mode sessions where none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    if sc is None:
        # Spark Connect: checkpoints are written by the server into its own
        # configured folder; nothing can be set from the client.
        return ""
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; cluster jobs need a shared folder "
            "for reliable checkpoints (set it in the session configuration)")
    folder = tempfile.mkdtemp(prefix="outcomelab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return folder


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back: lineage is cut like ``checkpoint()``, and later readers get
    column pruning and pushed-down filters, which a checkpointed RDD scan
    cannot offer.  Falls back to ``checkpoint()`` when no folder is known
    on the client (Spark Connect).  :func:`release` deletes the table."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        return df.checkpoint(eager=True)
    path = f"{folder.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._written_to = path
    return out


def materialize_by_key(df, name: str, key: str, buckets: int | None = None):
    """:func:`materialize` as a table bucketed by ``key``: tables written with the
    same number of buckets (the session's shuffle partitions, unless given)
    are joined on the key without an exchange.  Rows are dealt by key
    before they are written, so a bucket is one file."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        return df.checkpoint(eager=True)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"outcomelab_{name}_{uuid.uuid4().hex}"
    path = f"{folder.rstrip('/')}/tables/{table}"
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).mode("overwrite")
     .format("parquet").saveAsTable(table))
    out = spark.table(table)
    out._written_to, out._table = path, table
    return out


def release(*tables) -> None:
    """Delete the files of materialised tables that no plan will read again;
    other frames are left alone."""
    for t in tables:
        path = getattr(t, "_written_to", None)
        if path is None:
            continue
        spark = t.sparkSession
        if getattr(t, "_table", None):
            spark.sql(f"DROP TABLE IF EXISTS {t._table}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean(*frames) -> None:
    """Delete the files of checkpointed frames that no plan will read again, and have
    Spark drop the shuffle files of what is no longer referred to (it does so when
    the driver's garbage is collected, which big tables and a small driver seldom bring about)."""
    for df in frames:
        try:
            spark, jvm = df.sparkSession, df.sparkSession._jvm
            file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        except Exception:  # noqa: BLE001 - Spark Connect, or no checkpoint of its own: nothing to reach from here
            continue
        if file.isDefined():
            target = jvm.org.apache.hadoop.fs.Path(file.get())
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        gc.collect()
        jvm.System.gc()
