"""Session defaults and the shared work folder.

Scratch data (checkpoints, stream sources, versioned tables written by the
test queries) always goes under ``spark.checkpoint.dir``, which on a cluster
names a shared, reliable folder.  Only when that setting is absent (local
tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tarmac", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> str:
    """Send this package to all executors, as ``--py-files`` does; for sessions whose executors do not have it
    on their path.  Spark's own file distribution carries the archive; its name is returned."""
    import shutil

    folder = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tarmac-ship-"), "tarmac"), "zip",
                                  os.path.dirname(folder), os.path.basename(folder))
    spark.sparkContext.addPyFile(archive)
    return archive


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server's conf applies
        sc = None
    if not base:
        current = sc.getCheckpointDir() if sc is not None else None
        if current:
            base = current
        else:
            master = spark.conf.get("spark.master", "")
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tarmac-ckpt-")
            spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark)
    if "://" not in base:
        os.makedirs(base, exist_ok=True)
    return f"{base.rstrip('/')}/tarmac/{name}-{uuid.uuid4().hex}"
