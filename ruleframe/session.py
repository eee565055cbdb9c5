"""Session helpers: settings that are put back, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, object]) -> Iterator[None]:
    """Set SQL settings for the duration of a block and restore the former values."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder, and only in local mode: on a cluster
    a machine-local folder would not survive the loss of its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ruleframe-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Keep the intermediate tables of a block in one folder, which is deleted when the block ends.

    A result that reads them has to be written, or used up, inside the block.
    """
    folder = fresh_path(spark, "run")
    former = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(former)
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system that Spark reaches; nothing happens if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the folder of the run, or else below the shared one, that nothing was written to yet."""
    folder = _RUN_FOLDER.get() or f"{shared_folder(spark).rstrip('/')}/ruleframe"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage the way a reliable checkpoint does, but stays columnar: later readers still
    prune columns, and the planner knows the real size when it chooses between broadcast and
    shuffle. The files stay in the caller's checkpoint folder, unless :func:`run_folder` holds them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
