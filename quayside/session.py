"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never invents a machine-local folder on a cluster: scratch tables
go under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (tests, local
runs) do we pick one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(cpus: int | str = "*", app: str = "quayside", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (``spark.checkpoint.dir``).  Only a
    local-mode session (tests, a laptop) without one gets a local folder; a
    cluster session without one is an error, never a machine-local path."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="quayside-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (fresh when ``unique``)."""
    base = ensure_checkpoint_dir(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([base.rstrip("/")] + leaf)


def fs_for(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path objects for ``path`` (driver-side metadata only)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath
