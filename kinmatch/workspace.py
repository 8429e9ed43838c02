"""Where intermediate and result files go.

All files of one application lie under one folder, which the file system removes when the
application ends (Hadoop's deleteOnExit); `discard` removes a table earlier, when its last reader
is done. After a driver that was killed the folder stays, named by its application.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_roots: dict[str, str] = {}


def _base(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="kinmatch-"))
    return _own[0]


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def root(spark: SparkSession) -> str:
    """The application's folder: in spark.checkpoint.dir, or, where that is unset and Spark runs
    on this machine alone, in a temporary folder of this process."""
    application = spark.sparkContext.applicationId
    if application not in _roots:
        path = f"{_base(spark)}/kinmatch-{application}-{uuid.uuid4().hex[:8]}"
        files, p = _file(spark, path)
        files.mkdirs(p)
        files.deleteOnExit(p)
        _roots[application] = path
    return _roots[application]


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a Parquet table and read again, so that its readers don't compute it
    again and a lost executor takes nothing of it along."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the table of a result of `written` that nothing reads any more."""
    path = getattr(df, "_written_at", None)
    if path:
        files, p = _file(df.sparkSession, path)
        files.delete(p, True)


def spread(df: DataFrame, size_of: DataFrame | None = None) -> DataFrame:
    """The rows of a file scan (or of `df`, made of the scan `size_of`), dealt to all cores where
    the files are so small that they come in a split or two: less than 4 MB for each core, which
    is what Spark takes opening a file to be worth. Larger inputs are left as they are read."""
    spark = df.sparkSession
    size = int(str((df if size_of is None else size_of)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if size < cores * (4 << 20) else df
