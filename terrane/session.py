"""Session defaults and the shared folder for lineage cuts."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # steps that multiply rows follow small shuffles, so few bytes still mean work
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Shared folder of a local session that names none; there driver and executors are one.
LOCAL_DIR = "/tmp/checkpoints"

# applications whose written tables are removed when this process ends
_CLEANED: set[str] = set()


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may do without it, since there the driver and the executors
    share one file system.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith(
            "local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return LOCAL_DIR


def _own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder, removed when the process ends."""
    context = spark.sparkContext
    path = f"{shared_dir(spark).rstrip('/')}/terrane-{context.applicationId}"
    if context.applicationId not in _CLEANED:
        _CLEANED.add(context.applicationId)
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        files.deleteOnExit(folder)  # when Spark's JVM ends in good order
        atexit.register(_remove, files, folder)
    return path


def _remove(files, folder) -> None:
    try:
        files.delete(folder, True)
    except Exception:  # the JVM has gone, and deleteOnExit has done it
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back. It stays until the
    application ends, since later DataFrames read it lazily.

    For results that several later steps read: they are computed once, survive lost
    executors, keep column pruning, and their size is known to the join planner.
    """
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` over ``spark.sql.shuffle.partitions`` tasks, by key.

    For a table of few rows that every following task multiplies: adaptive execution
    would judge its size before the multiplication and leave it in one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *key)
