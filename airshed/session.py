"""Spark session defaults and the shared storage root.

Everything the engine writes (table versions, CSV snapshots, checkpoints)
lives under one root taken from the session: ``airshed.warehouse.dir`` if
set, else a folder inside ``spark.checkpoint.dir``. Only when neither is set
(unit tests, the local bench) do we create a scratch folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "airshed", extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC time zone and the UI off."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; create a scratch one
    only when the session has none and runs in one process (local tests)."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return cur.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="airshed-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def warehouse_root(spark: SparkSession) -> str:
    """Shared folder for table versions and snapshots."""
    root = spark.conf.get("airshed.warehouse.dir", None)
    if root:
        return root.rstrip("/")
    ckpt = ensure_checkpoint_dir(spark)
    root = ckpt.rstrip("/") + "/airshed-warehouse"
    spark.conf.set("airshed.warehouse.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the warehouse root."""
    return f"{warehouse_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``airshed`` importable in executor Python workers (the grouped
    maps pickle functions by module): zip the package into the shared
    checkpoint folder once per application and ``addPyFile`` it."""
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in sorted(os.walk(pkg)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    data = buf.getvalue()
    path = f"{ensure_checkpoint_dir(spark)}/airshed-pkg-{hashlib.md5(data).hexdigest()[:12]}/airshed.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        out = fs.create(hpath)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


# Spark deletes the shuffle files of a query when it ends, not at some later
# collection of the driver's heap.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _writers = threading.Lock(), {"n": 0, "before": None}


@contextmanager
def shuffles_go(spark: SparkSession):
    """The shuffle files of each query that starts inside are deleted when it
    ends: nothing reads them again once its table is written, and without
    this those of all steps of a job lie on the disks together. The session's
    own setting comes back when the last of several threads leaves."""
    with _writing:
        _writers["n"] += 1
        if _writers["n"] == 1:
            _writers["before"] = spark.conf.get(SHUFFLES_GO, None)
            spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _writing:
            _writers["n"] -= 1
            if not _writers["n"]:
                spark.conf.unset(SHUFFLES_GO) if _writers["before"] is None else spark.conf.set(SHUFFLES_GO, _writers["before"])


# Codec of the tables that a job writes for itself (about two thirds of Snappy's bytes).
CODEC = "zstd"


def write_table(df, path: str) -> None:
    with shuffles_go(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)


def materialize(df, name: str):
    """Cut lineage through a written Parquet table in the shared folder.

    One computation (``checkpoint()`` runs the plan once for the job and
    again to write the files), columnar read-back with pruning, real file
    sizes for AQE's broadcast decision, and it survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{name}")
    write_table(df, path)
    out = spark.read.parquet(path)
    out._written = path
    return out


def discard(df) -> None:
    """Delete the files of a table that ``materialize`` returned, once nothing
    reads it any more (the round before last of an iteration)."""
    path = getattr(df, "_written", None)
    if path:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def materialize_sized(df, name: str):
    """``materialize`` plus the written size in bytes (a proven bound for a
    broadcast decision)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{name}")
    write_table(df, path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    size = int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())
    return spark.read.parquet(path), size


def local_path(path: str) -> str:
    """Strip a file: scheme for os-level checks in local tests."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


__all__ = ["build_session", "ensure_checkpoint_dir", "warehouse_root",
           "scratch_path", "path_exists", "local_path", "materialize",
           "materialize_sized", "discard", "ship_package",
           "shuffles_go", "write_table"]
