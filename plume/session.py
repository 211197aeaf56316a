"""Session helpers: one place that builds a local session for tests/bench and
resolves the shared checkpoint folder.

On a cluster the session is supplied by the caller; nothing here overrides its
settings except where a setting is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "plume") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete reliable checkpoint files once their data is unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    conf = spark.sparkContext.getConf()
    value = conf.get(_CKPT_KEY, None)
    if value:
        return value
    try:
        value = spark.conf.get(_CKPT_KEY)
    except Exception:  # noqa: BLE001 - unset key raises on some versions
        value = None
    if value:
        return value
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()  # Option[String]
    return jdir.get() if jdir.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when unset in
    local mode (tests).  A cluster must name a shared folder in
    ``spark.checkpoint.dir``; without it this raises.
    """
    current = checkpoint_dir(spark)
    master = spark.sparkContext.master or ""
    if not current and not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster "
                           "(e.g. on the distributed file system); plume does not fall back "
                           "to a machine-local folder outside local mode")
    if current:
        # make sure the context uses it (the conf alone is read at start-up)
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not jdir.isDefined():
            spark.sparkContext.setCheckpointDir(current)
        return current
    scratch = tempfile.mkdtemp(prefix="plume-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return checkpoint_dir(spark) or scratch


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
