"""Session defaults and the durable way to cut a lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[list[str]] = []  # paths of the tables of each owner, the innermost last
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(
    master: str | None = None,
    app: str = "kindred",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; only a single local process may go without."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kindred-checkpoint-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    For results that several later steps read, such as a trained model. The table outlives lost
    executors, and its readers see its size. :func:`own_tables` deletes it. The shuffle files of the plan that made it
    go with its end, as nothing reads them again; they would stay until the driver happens to collect its garbage.
    """
    path = f"{shared_folder(df.sparkSession)}/kindred-{uuid.uuid4().hex}"
    for paths in _OPEN[-1:]:
        paths.append(path)
    with _shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Plans that are run inside remove their shuffle files in the end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized inside are deleted in the end, so results must be written or collected before.

    Without it they stay until the owner of the shared folder removes them, as lazy results read them.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _OPEN.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
