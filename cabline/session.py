"""Session helpers.

The jobs need UTC for parsing and printing instants.  Everything else
(shuffle partitions, AQE, memory) belongs to whoever owns the session; the
library only fills in settings that are unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs rely on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that make the plans scale (runtime SQL settings), applied to sessions
# built here, and only where the submitter (spark-defaults.conf, --conf) has not
# set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small shuffles are still coalesced, but not below 256 KB per task, so a
    # CPU-heavy stage after a small shuffle (parsing, path expansion) keeps
    # several tasks; large inputs are unaffected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Fall back from whole-stage codegen when a generated method is larger than
    # the JVM will JIT-compile (8000 bytes); otherwise it runs interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Fixed at start-up: no web UI (no port is opened by the library's sessions).
STARTUP_CONF = {
    "spark.ui.enabled": "false",
    # compiled query code is cached by its source; the default 100 entries hold
    # only a handful of these plans, so a session running many different jobs
    # would compile the same code again and again
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def ensure_required_conf(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, app: str = "cabline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the jobs expect.

    Explicit arguments win; ``DEFAULT_CONF`` fills in only what the submitter
    left unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**STARTUP_CONF, **explicit}.items():
        builder = builder.config(key, value)
    existing = SparkSession.getActiveSession()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if existing is None:               # a session someone else built keeps its settings
        submitted = spark.sparkContext.getConf()
        for key, value in DEFAULT_CONF.items():
            if key not in explicit and not submitted.contains(key):
                spark.conf.set(key, value)
    return ensure_required_conf(spark)


def checkpoint_dir(spark: SparkSession, sub: str | None = None) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever runs it, on a file system every
    executor reaches; we never fall back to a machine-local folder there.
    Only a local-mode session (tests, one machine) gets a scratch folder when
    nothing is configured.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(e.g. on HDFS or an object store) for checkpoints")
        base = tempfile.mkdtemp(prefix="cabline-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    base = sc.getCheckpointDir()
    if sub:
        return base.rstrip("/") + "/" + sub
    return base


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
