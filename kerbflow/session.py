"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime settings the plans are written for.  All of them can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the grouping after it then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Day partitions are text labels, also when read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Percentile sketches live in the object hash aggregate, outside managed memory: enough
    # groups per task to avoid needless sorting, few enough for full sketches to fit.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
    # Rows that go to a Python worker at once, by size: a join can put a long text on every
    # row, and both sides hold copies of a batch.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def get_session(
    app: str = "kerbflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session.  Leave ``master`` unset on a cluster; spark-submit supplies it."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = dict(RUNTIME_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; a cluster
    without it is a configuration error, because a machine-local folder would be lost
    with its executor.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="kerbflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/kerbflow/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path this session wrote."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
