"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "plexlake", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary one; on a cluster a
    machine-local folder would be lost to the other machines, so that is refused.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if configured:
        return configured
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all machines share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="plexlake-"))
    return context.getCheckpointDir()


_made: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, until :func:`remove_stages`."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_stages(spark: SparkSession) -> int:
    """Delete what this application wrote below the shared folder, once no result that reads it is needed.

    Only paths handed out by :func:`scratch_path` go; how many of them there were.
    """
    return sum(_delete(spark, path) for path in _made.pop(spark.sparkContext.applicationId, []))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one path that :func:`scratch_path` handed out, before the end."""
    _made.get(spark.sparkContext.applicationId, []).remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage before a table fans out into several jobs, and survives the
    loss of executors because the files live in shared storage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
