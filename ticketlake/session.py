"""Session settings and the shared scratch location.

Everything here is ordinary session configuration: UTC session time, AQE with
skew-join handling, and a checkpoint/scratch folder that lives in the shared
location the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone: the reference reads naive datetimes
# as UTC, so the session zone is pinned to UTC.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",   # small partitions of a cached result are joined too
    "spark.sql.variant.allowDuplicateKeys": "true",     # a repeated key: the last value holds
}
#: Shuffles begin with at least so many partitions; adaptive execution joins small ones.
INITIAL_PARTITIONS = 1024


def initial_partitions(shuffle_partitions: int) -> int:
    """A multiple of the session's shuffle partitions, so that a shuffle by key
    stays aligned with tables in that many buckets."""
    return shuffle_partitions * -(-INITIAL_PARTITIONS // shuffle_partitions)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the library depends on (idempotent).

    ``spark.sql.shuffle.partitions`` fits one size of input; with larger ones a
    task's share outgrows its memory and spills. Adaptive execution therefore
    begins with more partitions, unless the user has chosen their number, and
    gives a task as many as make up its advisory size."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(initial, None) is None:
        spark.conf.set(initial, str(initial_partitions(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_spark(master: str | None = None, app: str = "ticketlake",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only set when given, so a
    cluster submit keeps its own master."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, read from the
    session. Where it is unset, a cluster's warehouse folder serves, which all
    executors see; a session of one process (tests, the bench) gets a folder
    of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.startswith("local["):
            d = tempfile.mkdtemp(prefix="ticketlake-ckpt-")
        else:
            d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_ticketlake"
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared folder; whoever writes makes it."""
    return f"{checkpoint_dir(spark)}/ticketlake/{name}-{uuid.uuid4().hex[:12]}"
