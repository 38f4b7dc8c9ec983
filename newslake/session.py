"""Session construction and shared scratch locations.

Intermediate tables (snapshots, landing files, stream logs) must live on a
folder every executor can see.  The cluster names that folder in
``spark.checkpoint.dir``; we read it from the session.  Without it a session on one
machine (tests, laptops) gets a fresh local folder, and any other an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (a broadcast happens only when the measured side is under the threshold),
# splits skewed shuffle partitions, and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Bound the Arrow batches fed to the HTML parser (pages can be large).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "newslake",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set only if unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="newslake-ckpt-")  # one machine only: tests, laptops
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder; unique per call by default."""
    root = checkpoint_root(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex)
    return root.rstrip("/") + "/newslake/" + "/".join(leaf)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once a session: Python workers that do not
    share the driver's folders import the functions they run from it."""
    sc = spark.sparkContext
    if any(os.path.basename(p) == "newslake.zip" for p in getattr(sc, "_python_includes", [])):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="newslake-ship-"), "newslake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(uri)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


__all__ = ["DEFAULT_CONF", "build_session", "checkpoint_root", "shared_path", "path_exists", "ship_package"]
