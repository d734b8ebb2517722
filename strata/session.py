"""SparkSession factory and shared-storage helpers.

Everything that must survive an executor loss (stream checkpoints, staged
tables, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local runs,
tests) do we create one ourselves.
"""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Session settings the operators rely on.  AQE re-plans joins at runtime and
# splits skewed join partitions; UTC keeps the audit date columns stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs a shuffle afterwards
    # (e.g. a hot bid feeding a distinct that reuses the join's partitioning).
    # Applied only when AQE measures skew, so it costs nothing otherwise.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "strata",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster ``master`` stays ``None`` so spark-submit decides; the
    shuffle partition count is then left to the cluster config (AQE
    coalesces it at runtime anyway).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf not readable
        value = None
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    The value comes from ``spark.checkpoint.dir`` (session conf) or the
    SparkContext's checkpoint dir.  A private temp folder is used only when
    neither is set, which is the local/test case.
    """
    path = _conf(spark, "spark.checkpoint.dir")
    sc = getattr(spark, "sparkContext", None)
    if path is None and sc is not None:
        try:
            path = sc.getCheckpointDir()
        except Exception:
            path = None
    if path is None:
        master = _conf(spark, "spark.master") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            # A driver-local folder is invisible to executors on other hosts.
            raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a "
                               "shared folder (e.g. on the object store)")
        path = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        try:
            if sc.getCheckpointDir() is None:
                sc.setCheckpointDir(path)
        except Exception:
            pass
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir (never a local tmp dir)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/strata-scratch/{_run_id(spark)}/{uuid.uuid4().hex}/{name}"


_RUNS: dict[str, str] = {}


def _run_id(spark: SparkSession) -> str:
    """A folder name for this application; its scratch data goes with it."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = f"run-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(clean_scratch, spark)
    return _RUNS[app]


def scratch_zone(spark: SparkSession, name: str) -> str:
    """Name of a database that belongs to this run and goes with it."""
    return f"{name}_{uuid.uuid4().hex[:6]}_{_run_id(spark)[-8:]}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove what this application put below the scratch folder (also done at
    exit, if the session is still up then)."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped() or sc.applicationId not in _RUNS:
        return
    for zone in spark.catalog.listDatabases(f"*_{_RUNS[sc.applicationId][-8:]}"):
        spark.sql(f"DROP DATABASE IF EXISTS `{zone.name}` CASCADE")
    jpath = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/strata-scratch/{_RUNS[sc.applicationId]}")
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)


def path_join(*parts: str) -> str:
    """Join storage paths without touching the local filesystem."""
    head, *rest = parts
    out = head.rstrip("/")
    for p in rest:
        out = out + "/" + p.strip("/")
    return out


def _files(spark: SparkSession, folder: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path
    fs = jpath(folder).getFileSystem(sc._jsc.hadoopConfiguration())
    return fs, jpath, [s.getPath() for s in fs.listStatus(jpath(folder)) if not s.getPath().getName().startswith(("_", "."))]


def set_file_age(spark: SparkSession, folder: str, days: int) -> None:
    """Date the files of a folder ``days`` back."""
    fs, _, files = _files(spark, folder)
    at = int((time.time() - days * 86400) * 1000)
    for path in files:
        fs.setTimes(path, at, at)


def move_files(spark: SparkSession, folder: str, target: str) -> None:
    """Move the files of a folder into another one, keeping their dates."""
    fs, jpath, files = _files(spark, folder)
    fs.mkdirs(jpath(target))
    for path in files:
        fs.rename(path, jpath(f"{target}/{path.getName()}"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a storage path exists (a metadata call; errors are not hidden)."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()).exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is below it."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)
