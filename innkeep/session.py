"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs rely on. ANSI stays on: bad text becomes null through try_*
# functions where that is meant, and is an error everywhere else.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A raw booking takes a few bytes in a Parquet file or as a narrow row, and some
    # five hundred as a row of fifty columns. What a task reads is bounded so that its
    # sort of such rows stays in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # The JVM does not compile methods of more than 8000 bytes. A stage over
    # fifty columns can exceed that when fused into one method; then it is
    # better generated operator by operator, in methods that do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # State of streams outside the heap, with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings on a session that is already running; all can change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Only at start: without it every Column operation records its Python call site.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "innkeep", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    A folder of this machine is used only where the setting is absent and the
    whole of Spark runs in this process (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="innkeep-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no earlier call has returned."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
