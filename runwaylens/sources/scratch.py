"""Where intermediate tables go: the shared folder that the cluster names, never a local one there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where the session names none, a session on one machine gets a temporary folder; on a cluster
    that is an error, because the executors would not see each other's files.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody has used yet."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and fixes the row order.

    The written files survive the loss of executors, and every later scan of them
    sees the same partitions in the same order.
    """
    return stored_at(df, new_folder(df.sparkSession, label))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new folder and read it back with the same schema."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written folder, wherever its file system is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Put a written folder in the place of another, wherever both are; false where there is no such source."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path(source)):
        return False
    files.delete(path(target), True)
    files.mkdirs(path(target).getParent())
    if not files.rename(path(source), path(target)):
        raise OSError(f"{source} cannot be moved to {target}")
    return True


class Workspace:
    """Intermediate tables of one operator, under the shared folder.

    ``save`` writes a table and reads it back; ``drop`` deletes one that no later step reads.
    As a context manager it deletes all that were not given up with ``keep``.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.names = spark, new_folder(spark, label), set()

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.names.add(name)
        return stored_at(df, f"{self.root}/{name}")

    def keep(self, name: str) -> None:
        """The table belongs to the result, so it outlives the operator."""
        self.names.discard(name)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.root}/{name}")
            self.names.discard(name)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error) -> None:
        self.drop(*list(self.names))
