"""Session settings the transforms rely on, and reliable materialisation."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Records a call site per function call on the driver; only error texts use it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cpus: int | str = "*", app: str = "tamiz", memory: str = "8g", conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    n = "8" if cpus == "*" else str(cpus)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", n)
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder once per session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tamiz-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table a query writes."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Session setting for the bytes of rows in an Arrow batch, and its value where the session says nothing.
BATCH_KEY, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of some 4 MB, unless the session sets another size.

    Spark's own bound is 64 MB. A batch is held by the executor, while its buffers double, and by the worker at the same time;
    texts reach tens of MB in 10,000 rows.
    """
    if BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(BATCH_KEY, BATCH)


#: Session setting for the tasks that list folders, and how many a core gets where the session says nothing.
LISTING_KEY, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 2


def few_listing_tasks(spark: SparkSession) -> None:
    """Folders and files are listed by a few tasks for each core, unless the session sets another number.

    Spark's own bound is 10,000 tasks: with many small folders each task lists one, and starting a task takes longer than that.
    """
    if LISTING_KEY not in spark.conf.getAll:
        spark.conf.set(LISTING_KEY, LISTING_TASKS * spark.sparkContext.defaultParallelism)


#: Session setting for the least size of a partition, and its value where the session says nothing.
PARTS_KEY, PARTS = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "4k"


@contextlib.contextmanager
def small_parts(spark: SparkSession) -> Iterator[None]:
    """Meanwhile adaptive execution leaves partitions of 4 KB, 1 MB by itself, as long as there are cores for them.

    For writes that take long by the number of their files, not by their bytes. A size that the session sets stays.
    """
    ours = PARTS_KEY not in spark.conf.getAll
    if ours:
        spark.conf.set(PARTS_KEY, PARTS)
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(PARTS_KEY)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from there.

    For results that several later branches read: the work is done once, a lost
    executor does not bring it back, later scans read only the columns they
    need, and joins know the size of the result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
