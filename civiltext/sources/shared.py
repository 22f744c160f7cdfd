"""Where intermediate files may go: the folder the cluster names, never a machine's own."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

PART_BYTES = 16 << 20   # of texts in a partition, about


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Without that setting it is an error, but for local mode, where driver and executors are one
    process: there a folder is made for its lifetime.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="civiltext-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextlib.contextmanager
def stored(df: DataFrame, name: str, **options) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back; deleted at the end of the block.

    A lost executor then costs a read of its partitions, not their computation. ``options`` go to
    the writer.
    """
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.options(**options).parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


def in_parts(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` dealt evenly over so many partitions that each has about ``PART_BYTES`` of texts, so
    what a task holds and how long it takes do not grow with the table. A table that is smaller in
    all is not moved."""
    octets = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    if octets <= PART_BYTES:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism,
                              -(-octets // PART_BYTES)))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever the cluster keeps it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    A lost executor then costs a read of its partitions, not their computation.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()
