"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the word contracts define it: 0x09-0x0D and 0x20.
ASCII_SPACE = r"[\x20\x09-\x0D]+"

_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset and
    driver and executors are one process, as in tests, a temporary folder takes
    its place until the interpreter exits; elsewhere its lack is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    global _own_folder
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="loomseq-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return f"file://{_own_folder}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: While an intermediate table is written, its shuffle files go as soon as it stands, and batches between the JVM and Python stay small: whole texts are in them.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet under the settings of ``_WRITING``."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in _WRITING}
    for k, v in _WRITING.items():
        conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage in a place that outlives any executor, computes the rows
    exactly once, and gives the optimizer the true size of what follows.
    """
    path = shared_path(df.sparkSession, name)
    write_once(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one computation in the shared folder, which go when they have been read for the last time."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        write_once(df, path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def release(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, self.paths.pop(id(t))[0])

    def close(self) -> None:
        """Remove all that is left, and have Spark let go of shuffles that nothing refers to any more."""
        self.release(*(t for _, t in list(self.paths.values())))
        gc.collect()
        self.spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path that this library wrote, through Hadoop's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name
