"""Session settings, checkpoint folder and lake root.

Cluster jobs get their shared folders from the session: ``spark.checkpoint.dir``
(set by whoever launches the cluster) and, optionally, ``stellate.lake.root``.
A machine-local temporary folder is only ever used when the master is local
(tests, the bench) and nothing was configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that epoch and timestamp text do not
# depend on the machine zone, ANSI casts (we use try_cast where input may be
# dirty), dynamic partition overwrite for re-runnable fact writes, and AQE for
# runtime coalescing, skew splitting and broadcast conversion.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "stellate",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the settings above; UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of SESSION_CONF to a session of our
    own. A caller's session is left as it is: no operator needs these."""
    for k, v in SESSION_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster the folder must come from ``spark.checkpoint.dir``; only a
    local master may fall back to a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            conf = None
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is unset: point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-ckpt-"))
    return sc.getCheckpointDir()


def lake_root(spark: SparkSession) -> str:
    """Shared root for written tables: ``stellate.lake.root`` or a folder
    next to the checkpoint data."""
    try:
        root = spark.conf.get("stellate.lake.root", None)
    except Exception:
        root = None
    if root:
        return root.rstrip("/")
    return checkpoint_dir(spark).rstrip("/") + "/stellate-lake"


_made: list[str] = []   # intermediate folders of this process


def note_folder(path: str) -> str:
    """Have ``clean_run`` delete this folder."""
    _made.append(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the lake root, noted for ``clean_run``."""
    return note_folder(f"{lake_root(spark)}/{name}-{uuid.uuid4().hex[:12]}")


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete one folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_run(spark: SparkSession) -> int:
    """Delete the intermediate folders that this process noted (nothing
    else), once their results are no longer read.
    Returns how many there were. Checkpoints go when they are no longer
    referenced, where the session was built by ``build_session``."""
    n = sum(delete_folder(spark, path) for path in _made)
    _made.clear()
    return n


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can look at a local folder (tests)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
