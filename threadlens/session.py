"""Session construction and the shared scratch location.

On a cluster the session comes from the platform; ``ensure_defaults`` only
pins the settings the operators depend on for correct results (UTC, see
SURVEY D8) and fills in a checkpoint directory where none is configured
(local tests).  Scratch output always goes below ``spark.checkpoint.dir`` so
that it lives on shared storage and survives executor loss.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make results correct or plans skew-tolerant.  Sizes
# (shuffle partitions, broadcast threshold) are left to the deployment.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "threadlens", extra: dict | None = None) -> SparkSession:
    """A session for tests and the benchmark (local mode)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**_REQUIRED, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin UTC/AQE and give the session a checkpoint dir if it has none."""
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when a local session has none (tests) a fresh temporary folder is
    created and registered; on a cluster the setting is required, because
    executors would each write to a disk of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="threadlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/threadlens/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def batch_ids(spark: SparkSession, table_dir: str, column: str = "_batch") -> list[int]:
    """Ids of a table's published batch folders, ascending (a listing of folder names)."""
    if not path_exists(spark, table_dir):
        return []
    fs, p = _fs(spark, table_dir)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{column}="))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder (any Hadoop file system)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Make a fully written folder visible under its final name.

    Writers fill ``staged`` (a name starting with ``_`` and without ``=``,
    which Spark's file listing skips), then a rename publishes it, so a
    reader never lists half of a batch.  An existing folder of that name (a
    retried batch, or the previous version of a table) is first renamed aside
    and deleted once the new one is in place.  Renames are atomic on HDFS
    and local file systems.
    """
    fs, src = _fs(spark, staged)
    _, dst = _fs(spark, final)
    if not fs.exists(src):
        return
    parent, name = final.rstrip("/").rsplit("/", 1)
    _, old = _fs(spark, f"{parent}/_replaced_{name.replace('=', '_')}")
    if fs.exists(old):
        fs.delete(old, True)
    had_old = fs.exists(dst)
    if had_old and not fs.rename(dst, old):
        raise IOError(f"could not move {final} aside")
    if not fs.rename(src, dst):
        if had_old:
            fs.rename(old, dst)
        raise IOError(f"could not publish {staged} as {final}")
    if had_old:
        fs.delete(old, True)
