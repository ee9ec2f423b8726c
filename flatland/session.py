"""Session construction and the shared scratch area.

Run-scoped intermediates (parsed rows, fixtures, versioned tables in tests)
live under the folder named by ``spark.checkpoint.dir``: on a cluster that is
a shared file system, so any executor can read what another one wrote and a
lost executor costs a task retry, not a lost result. Only when the session has
no such setting (local tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_ROOT: str | None = None


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "flatland") -> SparkSession:
    """A session with the settings the library relies on.

    UTC session time zone (the landed timestamps are wall-clock values), AQE
    with partition coalescing and skew-join splitting, and no UI server.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLATLAND_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Archive expansion writes decompressed copies; keep Python workers alive.
        .config("spark.python.worker.reuse", "true")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset."""
    global _FALLBACK_ROOT
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = jdir.get() if jdir.isDefined() else None
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _FALLBACK_ROOT is None:
            _FALLBACK_ROOT = tempfile.mkdtemp(prefix="flatland-ckpt-")
        current = _FALLBACK_ROOT
        spark.conf.set("spark.checkpoint.dir", current)
    # RDD-level checkpoint() needs the context to know the folder too.
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not jdir.isDefined():
        spark.sparkContext.setCheckpointDir(current)
    ship_package(spark)
    return current


def split_session(spark: SparkSession, split_bytes: int | None) -> SparkSession:
    """A session that reads files in splits of that size; the caller's own is left alone, as feeds of a sweep run side by side."""
    if not split_bytes:
        return spark
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.files.maxPartitionBytes", str(int(split_bytes)))
    return own


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers (as ``--py-files`` would).

    The few helpers that run Python on executors refer to functions of this
    package; the workers must be able to import it wherever the driver runs.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)          # first, since scratch_root() below comes back here
    import io
    import zipfile

    from flatland import storage
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    # Into the shared scratch area, where every executor can fetch it.
    out = f"{scratch_root(spark)}/pyfiles/{app}-{uuid.uuid4().hex[:8]}/flatland.zip"
    storage.write_bytes(spark, out, buf.getvalue())
    sc.addPyFile(out)


def scratch_root(spark: SparkSession) -> str:
    """Folder for flatland's own intermediates, inside the checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/flatland"


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder for one run of one operator."""
    return f"{scratch_root(spark)}/runs/{label}-{uuid.uuid4().hex[:12]}"


def run_name(label: str) -> str:
    """Pattern of the names that ``new_run_dir`` gives to a label's folders, and to no other label's."""
    return f"{re.escape(label)}-[0-9a-f]{{12}}"
