"""Tables written to the cluster's shared folder, to cut lineage.

A staged table survives the loss of executors, is computed once however many
plans read it, and has a size that the planner knows when it decides on a
broadcast. The folder is the one named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .tables import write_table


def staging_root(spark: SparkSession) -> str:
    """The shared folder. Where none is set a local session gets a folder of its
    own; a cluster session must name one, since its executors share no disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="reportmart-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


#: The folder that what is staged now goes to, below the shared one.
_folder: ContextVar[str] = ContextVar("_folder", default="reportmart")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{staging_root(spark)}/{_folder.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_folder(spark: SparkSession) -> Iterator[None]:
    """What is staged within goes to a folder of its own, which is removed at the end, also
    when it fails. A thread takes part if it runs in a copy of this context. Frames that
    read such a table can't be used afterwards."""
    folder = f"reportmart/run-{uuid.uuid4().hex}"
    token = _folder.set(folder)
    try:
        yield
    finally:
        _folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/{folder}")
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    write_table(df, path, partition_by=partition_by, rebalance=False)
    return spark.read.schema(df.schema).parquet(path)
