"""Reading and writing of flat tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession


WRITERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
#: Partition folders that a task fills side by side; only rows of further ones are sorted.
WRITERS = 16


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within do not sort all their rows by partition first, unless the
    session has a setting of its own."""
    if spark.conf.get(WRITERS_SETTING, "0") != "0":
        yield
        return
    spark.conf.set(WRITERS_SETTING, WRITERS)
    try:
        yield
    finally:
        spark.conf.unset(WRITERS_SETTING)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None when there is no such path. Any other
    failure to read it is an error, not an empty table."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def partition_files(spark: SparkSession, path: str, partitions: Sequence[str]) -> list[str]:
    """The files below those folders of the table at ``path``; ``partitions`` are patterns."""
    found: list[str] = []
    for pattern in partitions:
        try:
            found += spark.read.option("basePath", path).parquet(f"{path}/{pattern}").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def remove_files(spark: SparkSession, files: Sequence[str]) -> None:
    """Remove files by the file system that holds them; what is gone already stays gone."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for uri in files:
        file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        file.getFileSystem(conf).delete(file, False)


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace: str = "all",
    files: int | None = None,
    rebalance: bool = True,
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Write ``df``, replacing what is there; an empty result replaces it too.

    ``replace="touched"`` replaces only the partitions that ``df`` has rows for.
    With ``partition_by`` the rows of one partition are brought together first,
    so that each folder gets few files; the rebalance splits a partition that
    holds far more rows than the rest over several tasks. A task keeps a few partitions
    open at a time, so that wide rows are not sorted, and spilled, to be written. ``derived``
    are columns of ``df`` that follow from its others: they are made anew once the rows are
    together, not shuffled. ``files`` asks for that many output files; leave it unset unless
    the result is small.
    """
    if replace not in ("all", "touched"):
        raise ValueError(f"replace must be 'all' or 'touched', not {replace!r}")
    if files is not None:
        df = df.repartition(files)
    elif partition_by and rebalance:
        derived, columns = derived or {}, df.columns
        df = df.drop(*derived).hint("rebalance", *partition_by)
        df = df.withColumns(derived).select(columns) if derived else df
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        mode = "dynamic" if replace == "touched" else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", mode)
    with side_by_side(df.sparkSession) if partition_by else nullcontext():
        writer.save(path)
