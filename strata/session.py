"""Session helpers: the settings the transforms are tuned for, and the
shared checkpoint folder.

Transforms never create sessions; callers pass one in.  ``build_session`` is
for tests, the bench and local runs.  On a cluster, apply
``SCALE_SETTINGS`` (or equivalent cluster defaults) and keep the cluster's
own ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on.  All are plain Spark SQL options.
SCALE_SETTINGS: dict[str, str] = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions (hot keys, NULL keys of outer joins), and turn a
    # sort-merge join into a broadcast join when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if what follows needs another shuffle
    # for it (an aggregate on the join key, say).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Broadcast only below a measured size (file statistics at plan time,
    # shuffle statistics at run time).  Dimension tables above this size are
    # joined by shuffle instead.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Steps that run side by side share the executors evenly.
    "spark.scheduler.mode": "FAIR",
    # Timestamps are stamped and parsed in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Scan splits sized for executor memory.
    "spark.sql.files.maxPartitionBytes": "256MB",
    # Remove checkpoint files (rank inputs) once nothing references them, so
    # the shared checkpoint folder does not grow run after run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "strata",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with ``SCALE_SETTINGS``; UI off, no server started."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SCALE_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).

    Only a ``local`` session without one gets a scratch folder (tests, local
    runs); on a cluster a machine-local folder would be wrong, so a missing
    setting is an error there."""
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (e.g. on the "
            "cluster file system) for checkpoints and streaming state"
        )
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def state_location(spark: SparkSession, name: str) -> str:
    """A named sub-folder of the shared checkpoint folder (streaming state).

    Built from the configured folder, so that another session with the same
    setting finds it again: Spark's own checkpoint folder is a new one below
    it in each session."""
    current = ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or current.rstrip("/").rpartition("/")[0]
    return f"{base.rstrip('/')}/{name}"
