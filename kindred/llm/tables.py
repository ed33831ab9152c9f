"""Reading tables and cutting lineage in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FIRST = -(1 << 63)  # stands for a null id inside the operators, and sorts before all others


def text_key(text: Column) -> Column:
    """The key of a text: four bytes in the order of its hash, which orders the texts of one id, and 128 bits of SHA-256.

    A null text has the four bytes alone, so no text shares its key.
    """
    order = F.unhex(F.lpad(F.hex(F.hash(text).cast("long") + (1 << 31)), 8, "0"))
    return F.concat(order, F.coalesce(F.unhex(F.left(F.sha2(text, 256), F.lit(32))), F.lit(b"")))


def keyed(docs: DataFrame, *others: str) -> DataFrame:
    """Id and text with the key ``_id``, ``_key`` of a row, whose columns are never null.

    Rows that agree in both are copies of one row; ids may repeat or be null. Columns of ``docs``
    other than ``others`` are left behind, whatever their names.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *others)
    return docs.withColumns({"_id": F.coalesce("doc_id", F.lit(FIRST)), "_key": text_key(F.col("text"))})


KEY = ["_id", "_key"]
KEY_SCHEMA = "_id long, _key binary"


class Scratch:
    """Tables of one run in the folder that ``spark.checkpoint.dir`` names.

    A table outlives lost executors and cuts the lineage. ``drop`` removes one that no later step
    reads; ``close`` removes the rest. Results that are returned lazily need the last tables, so a
    query leaves those to the owner of the folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}", {}

    def keep(self, df: DataFrame, **options: str) -> DataFrame:
        """Write ``df`` and go on from there; the shuffle files behind it are dropped at once."""
        path = f"{self.root}/{uuid.uuid4().hex}"
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.options(**options).parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, hadoop = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for frame in frames:
            known = self.paths.pop(id(frame), None)
            if known:
                path = jvm.org.apache.hadoop.fs.Path(known[1])
                path.getFileSystem(hadoop).delete(path, True)

    def close(self) -> None:
        self.drop(*[frame for frame, _ in self.paths.values()])
