"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import re
import site
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "riskspark") -> SparkSession:
    """A local session for tests and the bench (the cluster supplies its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small local files: let a scan split them over the cores (no effect on
        # large files, where spark.sql.files.maxPartitionBytes decides).
        .config("spark.sql.files.openCostInBytes", str(512 * 1024))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system. Only in ``local[...]``
    mode (tests), when nothing set it, is a folder chosen here; the setting
    itself cannot change at run time, so the SparkContext's checkpoint folder
    is set instead. Anywhere else an unset folder is an error: a folder on one
    machine is not seen by the others.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    if path:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError(f"{CHECKPOINT_CONF} is not set: name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="riskspark-ckpt-")
    sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, once a session: its files go along with the job.

    Nothing happens where the workers find it by themselves (installed, on ``PYTHONPATH``, or started in its folder)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd(), *site.getsitepackages()]
    if any(p and os.path.realpath(p) == os.path.realpath(root) for p in known) or spark.conf.get("spark.riskspark.shipped", None):
        return
    package = os.path.join(tempfile.mkdtemp(prefix="riskspark-"), "riskspark.zip")  # read by the driver alone
    with zipfile.ZipFile(package, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "riskspark")):
            for n in names:
                if not n.endswith(".pyc"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    spark.addArtifacts(package, pyfile=True)
    spark.conf.set("spark.riskspark.shipped", "true")


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a written table, through the file system layer that Spark writes with."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskspark/{name}-{uuid.uuid4().hex[:12]}"
