"""Session construction and shared scratch locations.

Intermediate tables, streaming checkpoints and sink outputs created by the
library live under the folder the cluster names in ``spark.checkpoint.dir``
(a shared file system on a cluster).  Only when that setting is absent -- unit
tests, a laptop -- does the library pick a local folder and register it.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of ours wants; none of them changes results.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[8]", app: str = "txstream",
                shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    merged = dict(DEFAULT_CONF)
    merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; a local folder is created and registered only when
    the setting is unset (as in tests), so ``DataFrame.checkpoint()`` and our
    scratch tables always have a reliable home.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (sc.master or "").startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all machines share; a local"
                           f" folder does not serve {sc.master}")
    root = tempfile.mkdtemp(prefix="txstream-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one run's tables or checkpoints."""
    return f"{checkpoint_root(spark)}/txstream-scratch/{name}-{uuid.uuid4().hex[:12]}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table in the shared scratch folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing) and
    pins results that must be identical for every consumer of the frame --
    e.g. rows numbered after a sampled range partitioning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_parquet(df, path)
    _made_here().append(path)
    return spark.read.parquet(path)


def write_parquet(df, path: str) -> None:
    """Write ``df``; its shuffle files go when the write ends, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    if before == "true":      # set by the caller, or by another thread that resets it
        df.write.parquet(path)
        return
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)


_made = threading.local()


def _made_here() -> list[str]:
    """Paths materialized by this thread in its innermost :func:`temporary_tables`."""
    return getattr(_made, "paths", [])


@contextmanager
def temporary_tables(spark: SparkSession):
    """Deletes at its end the tables this thread materialized inside.

    Frames that read them may not be used afterwards.  After an error they stay, for
    :func:`cleanup_scratch`.
    """
    outer, own = _made_here(), []
    _made.paths = own
    try:
        yield
    finally:
        _made.paths = outer
    sc = spark.sparkContext
    for path in own:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def settled(spark: SparkSession, make, name: str):
    """``materialize`` the frame that ``make`` returns, and delete the tables ``make`` materialized for it."""
    path = scratch_path(spark, name)
    with temporary_tables(spark):
        write_parquet(make(), path)
    _made_here().append(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``txstream`` importable in Python workers (as ``--py-files`` would).

    Arrow-batched pandas stages pickle functions that live in this package, so
    the workers must import it.  The package is zipped once per application
    (one file per content digest) and added with ``addPyFile``; Spark
    distributes it with the job's other files.  Safe to call from many threads.
    """
    import hashlib
    import io
    import os
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        pkg = Path(__file__).resolve().parent
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(pkg.rglob("*.py")):
                info = zipfile.ZipInfo(str(f.relative_to(pkg.parent)), (2020, 1, 1, 0, 0, 0))
                z.writestr(info, f.read_bytes())
        data = buf.getvalue()
        digest = hashlib.sha1(data).hexdigest()[:12]
        folder = Path(tempfile.gettempdir()) / f"txstream-pyfiles-{digest}"
        folder.mkdir(parents=True, exist_ok=True)
        target = folder / f"txstream-{digest}.zip"
        if not target.exists() or target.read_bytes() != data:
            tmp = folder / f".{uuid.uuid4().hex}.zip"
            tmp.write_bytes(data)
            os.replace(tmp, target)
        try:
            sc.addPyFile(str(target))
        except Exception as e:  # noqa: BLE001 - the same file added before is fine
            if "already" not in str(e).lower():
                raise
        _SHIPPED.add(sc.applicationId)


def cleanup_scratch(spark: SparkSession, older_than_s: float, root: str | None = None) -> int:
    """Delete this library's scratch folders older than ``older_than_s`` seconds.

    Only direct children of ``<spark.checkpoint.dir>/txstream-scratch`` (or of
    ``root``) are considered; the age is their modification time by the file
    system's clock compared with a fresh marker's.  Returns how many were deleted.
    Call it between jobs: a folder still read by a live query must be younger.
    """
    base = root or f"{checkpoint_root(spark)}/txstream-scratch"
    sc = spark.sparkContext
    jvm = sc._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(base)
    fs = fs_path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return 0
    probe = jvm.org.apache.hadoop.fs.Path(f"{base}/.clock-{uuid.uuid4().hex}")
    fs.create(probe, True).close()
    now_ms = fs.getFileStatus(probe).getModificationTime()
    fs.delete(probe, False)
    deleted = 0
    for st in fs.listStatus(fs_path):
        if st.isDirectory() and now_ms - st.getModificationTime() > older_than_s * 1000:
            fs.delete(st.getPath(), True)
            deleted += 1
    return deleted
