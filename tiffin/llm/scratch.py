"""Tables an operator writes between its steps, in the folder all executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tiffin.session import shared_folder


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


_made: ContextVar[list[Scratch] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_made() -> Iterator[list[Scratch]]:
    """Lists the folders that are made inside the block, for who knows when their tables are no longer read."""
    made: list[Scratch] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)


class Scratch:
    """A folder for one run of an operator, below ``spark.checkpoint.dir``.

    A stored table cuts the lineage: a lost executor costs the tasks that it ran, nothing before the
    table. Tables go with ``drop`` after their last reader. What a result still reads stays until ``close``, or
    until the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.close)
        if (made := _made.get()) is not None:
            made.append(self)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        # Tables with texts are a third smaller than with Spark's default, and short-lived disk is what is scarce.
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.folder}/{name}")

    def read_by(self, df: DataFrame) -> bool:
        """Whether ``df`` reads tables of this folder."""
        return any(f"/{self.folder.rsplit('/', 1)[1]}/" in file for file in df.inputFiles())

    def close(self) -> None:
        atexit.unregister(self.close)
        try:
            delete_path(self.spark, self.folder)
        except Exception:  # the session has ended, and its file systems with it
            pass
