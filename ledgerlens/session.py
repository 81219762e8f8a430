"""Session helpers: UTC pinning, AQE defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  Timestamps are interpreted in UTC (the
# events carry no zone); ANSI stays on, so every lenient conversion goes
# through try_* functions.
LAKE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM never compiles a method of more bytecode: wide rows in one generated
    # method would be interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # records kept as VARIANT are written and read whole: taking each apart for the
    # file and putting it together again costs more than parsing it
    "spark.sql.variant.inferShreddingSchema": "false",
}
TASKS_PER_CORE = 3


def build_session(master: str | None = None, app_name: str = "ledgerlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so spark-submit decides.  The UI is
    off: batch jobs do not need it and it opens a port.
    """
    b = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # call-site capture for error messages costs several py4j round
         # trips per function call while a plan is built
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if master:
        b = b.master(master)
    for k, v in LAKE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def lake_session(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings the transforms depend on (UTC, AQE)."""
    for k, v in LAKE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    # many small files packed into about as many tasks as cores run in two waves
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already point at shared storage and is only read:
    a folder of one machine would hide each executor's files from the others,
    so an unset folder is an error there.  With a local master a private
    folder is created and registered, so ``DataFrame.checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/ledgerlens/{name}-{uuid.uuid4().hex[:12]}"
