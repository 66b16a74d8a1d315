"""Session settings and the shared working folder.

The engine never builds its own SparkSession inside operators; callers pass
one in. ``configure`` applies the settings every job here relies on, and
``build_session`` is the convenience used by tests, the bench and the CLI.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on (timestamps without zone, errors on bad
# casts) and settings for scale (adaptive re-planning, skew splitting).
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-part name sets are small; keep them in the hash map of a task instead
    # of sorting its rows once it holds 128 parts.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "200000",
    # Nanosecond timestamps written by pandas arrive as epoch-nanos longs and
    # are converted in the typed Bronze projection.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a live session.

    Python workers get the folder that the driver imported this package from on
    their path; where it isn't installed or shipped (``--py-files``) but the
    folder is there, as in local mode, their functions can then be loaded.
    """
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    env, home = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return spark


#: Stored bytes of the input behind one shuffle partition, and most bytes of a task that scans files or reads a
#: shuffle: a task holds the keys of its share, so shares stay the same and their number grows with the input.
PARTITION_BYTES, SCAN_BYTES, SHUFFLE_BYTES = 4 << 20, 8 << 20, 16 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _conf_bytes(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Settings by the size of what a job reads: adaptive execution starts from as many shuffle partitions as the
    input needs and joins them up to SHUFFLE_BYTES. Smaller tasks that the session asks for are left alone."""
    for key, most in (("spark.sql.files.maxPartitionBytes", SCAN_BYTES), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLE_BYTES)):
        if _conf_bytes(spark, key) > most:
            spark.conf.set(key, str(most))
    spark.conf.set(_INITIAL, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // PARTITION_BYTES))))


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "partwise",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PARTWISE_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SESSION_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


#: Where the lake is, unless a call says so, and the folder if neither does.
ROOT_CONF = "spark.partwise.lake.root"
DEFAULT_ROOT = "lakehouse"


def lake_root(spark: SparkSession, root: str | None = None) -> str:
    """The lake's root folder: the argument, else the session's ROOT_CONF, else DEFAULT_ROOT."""
    return (root or spark.conf.get(ROOT_CONF, None) or DEFAULT_ROOT).rstrip("/")


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint directory (``spark.checkpoint.dir``).

    It is visible to every executor, so written tables and checkpoints there
    survive the loss of an executor. A session without one is an error, except
    on a local master (tests), where all tasks share this machine's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext._jsc.sc()
    if not base and context.getCheckpointDir().isDefined():
        base = context.getCheckpointDir().get()
    if not base:
        if not context.isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="partwise-ckpt-")
    if context.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{shared_base(spark)}/{name or 'partwise'}-{uuid.uuid4().hex[:12]}"
