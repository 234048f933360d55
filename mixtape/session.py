"""Session construction and shared-storage helpers.

Intermediate tables are written under the folder named by
``spark.checkpoint.dir``, which cuts lineage and survives lost executors. On a
cluster that folder must already be configured (a shared file system / object
store); only a local master may fall back to a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults every session of ours gets; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "mixtape",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if (master or "").startswith("local"):
        # local mode: the driver JVM is the only executor
        settings.setdefault("spark.driver.memory", os.environ.get("MIXTAPE_DRIVER_MEMORY", "12g"))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring one only for local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf lookup differences
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) before running on a cluster")
        configured = tempfile.mkdtemp(prefix="mixtape-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written artefacts."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/mixtape-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch paths made inside are released at the end: for results that are written
    elsewhere before the scope closes."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def default_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"


def stage(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and return a
    scan of it: cuts lineage, survives executor loss, and gives the planner the
    table's real size. For inputs that a plan reads several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
