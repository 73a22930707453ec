"""Session helpers: a local session for tests/bench, the shared work folder,
and shipping this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_PKG_DIR = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()
_lock = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "campfin", event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster the caller's session is used.

    ``event_log_dir`` writes Spark's event log there (stage and task times
    without the web UI, which stays off)."""
    builder = SparkSession.builder
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (tests on a bare local
    session) a folder is chosen and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="campfin-ckpt-", dir="/tmp")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir().rstrip("/")


_scratch_root: ContextVar[str | None] = ContextVar("campfin_scratch", default=None)


@contextmanager
def scratch_under(folder: str):
    """Scratch of this thread goes under ``folder`` (which is dropped with its run)."""
    token = _scratch_root.set(folder)
    try:
        yield
    finally:
        _scratch_root.reset(token)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared dir (never machine-local on a cluster)."""
    root = _scratch_root.get() or f"{shared_dir(spark)}/campfin-work"
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df):
    """Spread an under-split input over the cluster: when a scan yields fewer
    partitions than ``spark.default.parallelism`` (a few small or unsplittable
    files), round-robin it to that many; large inputs are left as they are."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def local_fs_path(path: str) -> str | None:
    """Plain OS path for ``file:`` URIs and bare paths, else None."""
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" not in path:
        return path
    return None


def ship_package(spark: SparkSession) -> None:
    """Make ``campfin`` importable in Python workers (pandas UDFs, data sources)."""
    sc = spark.sparkContext
    key = sc.applicationId
    with _lock:
        if key in _shipped:
            return
        out_dir = local_fs_path(shared_dir(spark))
        if out_dir is None:  # remote shared FS: build the zip locally, Spark uploads it
            out_dir = tempfile.mkdtemp(prefix="campfin-pkg-")
        os.makedirs(out_dir, exist_ok=True)
        zpath = os.path.join(out_dir, f"campfin-pkg-{key}.zip")
        if not os.path.exists(zpath):
            tmp = zpath + f".{uuid.uuid4().hex}.tmp"
            with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as zf:
                root = os.path.dirname(_PKG_DIR)
                for dirpath, _dirs, files in os.walk(_PKG_DIR):
                    if "__pycache__" in dirpath:
                        continue
                    for f in files:
                        if f.endswith(".py"):
                            full = os.path.join(dirpath, f)
                            zf.write(full, os.path.relpath(full, root))
            os.replace(tmp, zpath)
        sc.addPyFile(zpath)
        _shipped.add(key)
