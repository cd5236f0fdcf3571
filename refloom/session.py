"""Session helpers: a tuned local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "refloom") -> SparkSession:
    """Session used by tests, bench and the driver entry when none is given.

    On a cluster, build the session with the cluster's own settings instead; only
    ``spark.sql.adaptive.*`` matters to the operators here (coalesce, skew join,
    runtime broadcast choice).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("REFLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="refloom-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only where it is unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that wins. Only a
    local-mode session without one (tests, bench) gets a fresh scratch folder; a
    cluster session without one is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "so iterative operators can cut lineage reliably"
        )
    scratch = tempfile.mkdtemp(prefix="refloom-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``refloom`` importable in Python workers (archive reading, dBASE source,
    fixture writers): zip the package once per application and ``addPyFile`` it, so
    executors get it whatever the driver's working directory or the cluster layout."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="refloom-pkg-"), "refloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
