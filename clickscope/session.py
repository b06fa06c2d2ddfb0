"""Session helpers.

Operators never build a session or set a master; they take DataFrames. These
helpers are for tests, the bench and the entry module, and for the one piece of
shared storage the jobs need: a folder that survives executor loss.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run wants: AQE re-plans joins (size-checked broadcast with a
# sort-merge fallback), splits skewed join partitions and coalesces small
# shuffle partitions; UTC makes epoch <-> text conversions match the oracle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # No broadcast from static estimates: un-costed join estimates can make a
    # fact table look like the small side, and a static broadcast cannot be
    # undone at runtime. Broadcasts come from explicit, size-checked hints
    # (plans.joins.bounded_broadcast) or from AQE on measured sizes below
    # this bound; above it the join stays a shuffled (sort-merge) join.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete checkpoint files once their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Local runs only: in local mode the executors live in the driver JVM, whose
# default 1 GiB heap makes long sessions GC-bound. Clusters size their own.
LOCAL_CONF = {
    "spark.driver.memory": "8g",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "clickscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if master.startswith("local"):
        conf.update(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and written tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it, or from the
    context's checkpoint folder. Only a local session (tests) may have none:
    one is then made and set. On a cluster a machine-local folder would not be
    seen by the other machines, so a missing one is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    local = "file:" + tempfile.mkdtemp(prefix="clickscope-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``checkpoint()`` has the shared folder to write to."""
    base = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base


def fresh_subdir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder (one per run), made through the
    file system that Spark resolves the path with, whatever its scheme."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    return fs.makeQualified(path).toString()
