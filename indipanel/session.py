"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "20g",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and benchmarks; a cluster supplies its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("indipanel")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder named by spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine: on a cluster
    the executors would each see a different one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="indipanel-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def few_listing_tasks(spark: SparkSession) -> None:
    """Let Spark list folders by a few tasks a core. Its own limit of 10,000 makes nearly every folder a task,
    which takes far longer to start than to run. A limit that the session has set stays."""
    limit = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(4 * spark.sparkContext.defaultParallelism))


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python in batches of about 1 MB. By its own limit of 64 MB each running task
    holds several times as much beyond the heap, in the JVM and in Python. A limit that the session has set stays."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, "1000k")


def utc(stamp: datetime | None = None) -> datetime:
    """The given time, or now, in UTC; a time without zone is taken as UTC."""
    if stamp is None:
        return datetime.now(timezone.utc)
    return stamp.replace(tzinfo=timezone.utc) if stamp.tzinfo is None else stamp.astimezone(timezone.utc)


def instant(stamp: datetime) -> Column:
    """A point in time as a literal, independent of the session time zone."""
    since = stamp - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(since // timedelta(microseconds=1)))
