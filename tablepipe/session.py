"""Session settings and the shared scratch location.

Every job writes intermediate tables under the shared folder the cluster names
in ``spark.checkpoint.dir``. A private folder is only created when the setting
is absent, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume: ANSI on, UTC session zone,
# dynamic partition overwrite, adaptive execution with skew handling.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tablepipe", extra: dict | None = None) -> SparkSession:
    """A local session for tests, benches and the command-line jobs."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TABLEPIPE_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for key, value in DEFAULT_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _spark_context(spark)
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = sc.master if sc is not None else "connect"
    if not master.split("[")[0].split(":")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    # Unset on a local master: one machine, as in tests.
    local = tempfile.mkdtemp(prefix="tablepipe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/tablepipe-scratch/{name}-{uuid.uuid4().hex[:12]}"


def _spark_context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablepipe`` importable in Python workers (UDTFs, the paged Data
    Source): zip the package into the shared scratch folder once per session
    and add it with ``addPyFile``. A cluster launched with ``--py-files``
    already has it; this is a no-op when workers can import it some other way
    only if the zip was added before."""
    sc = _spark_context(spark)
    if sc is None:
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    dest = scratch_path(spark, "pyfiles")
    local_dir = dest[len("file:"):] if dest.startswith("file:") else dest
    if "://" in local_dir:  # remote shared folder: build locally, ship from there
        local_dir = tempfile.mkdtemp(prefix="tablepipe-zip-")
    os.makedirs(local_dir, exist_ok=True)
    path = os.path.join(local_dir, "tablepipe.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
