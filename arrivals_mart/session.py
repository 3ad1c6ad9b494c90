"""Session helpers: a local session for tests and the bench, and the shared
scratch folder that jobs write intermediate tables to.

Scratch output always lives under the cluster's ``spark.checkpoint.dir``
(a shared filesystem on a real cluster). Only a single-process local session
may leave it unset; any other one raises.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "arrivals_mart") -> SparkSession:
    """Session used by tests and the bench (driver-only local mode)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, with its scheme.

    A session in one process (``local[...]``) may leave the setting unset; it
    then gets a private folder below the system's temporary folder, which is
    also written back to the setting. Any other master must name a folder that
    all its executors share, so an unset setting raises there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or _set_on_context(spark)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = "file://" + os.path.join(tempfile.gettempdir(), f"arrivals-mart-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def _set_on_context(spark: SparkSession) -> str | None:
    """The folder of an earlier ``setCheckpointDir``, if any."""
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make the session's RDD checkpoints go to :func:`checkpoint_root`; return that folder."""
    root = checkpoint_root(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def _application_scratch(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id", "") or "app"
    return f"{checkpoint_root(spark)}/scratch/{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application below the shared checkpoint folder."""
    return f"{_application_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to a fresh scratch folder and read it back.

    The columns stay columnar with statistics, the lineage is cut, and what
    stands before is computed once however often the result is used.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder of this application, once its results are written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_application_scratch(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(root):
        fs.delete(root, True)


# Settings for large inputs, applied by the command line unless spark-submit
# already set them: input splits and shuffle partitions of about 256 MB, and
# AQE with skew-join splitting.
SCALE_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_scale_defaults(spark: SparkSession) -> dict[str, str]:
    """Set :data:`SCALE_DEFAULTS` where the application did not set a value; return what was set."""
    try:
        submitted = spark.sparkContext.getConf()
        is_set = submitted.contains
    except Exception:  # noqa: BLE001 - Spark Connect: only the session conf is visible
        def is_set(key: str) -> bool:
            return spark.conf.get(key, None) not in (None, "")

    applied = {}
    for key, value in SCALE_DEFAULTS.items():
        if not is_set(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied
