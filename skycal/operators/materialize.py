"""Cut a lineage at a written table in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local-mode session may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="skycal-")
    return _local_folders[context.applicationId]


# The JVM compiles no method beyond so many bytes, and interprets it however often it runs.
COMPILED = 8000
# Stored tables are of doubles mostly, of which this saves a tenth more than Spark's own default.
CODEC = "zstd"


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's own value is back afterwards."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """While tables of many columns are written: a step whose one generated method would be too large to be compiled is run as
    several smaller ones. The session's own limit is back afterwards."""
    name = "spark.sql.codegen.hugeMethodLimit"
    with _set(spark, name, str(min(int(spark.conf.get(name)), COMPILED))):
        yield


def shuffles_dropped(spark: SparkSession):
    """While a table is written: the shuffle files of the write go when it ends, and not when the driver happens to collect
    its garbage, which may be never while a job runs."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_open: list[list[str]] = []


@contextmanager
def dropped_afterwards(spark: SparkSession) -> Iterator[None]:
    """Tables that materialize() writes meanwhile are deleted at the end: for steps whose result is stored elsewhere by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def materialize(df: DataFrame, label: str = "cut", dictionary: bool = True) -> DataFrame:
    """Write df once as Parquet and read it back: later passes over it are column-pruned scans,
    and a lost executor costs a re-read, not the whole plan behind it. The tables of one application
    share a folder, which may be deleted once its results are read. Without dictionary, wide tables of doubles are
    written in half the time."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/skycal-{spark.sparkContext.applicationId}"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    with compiled_methods(spark), shuffles_dropped(spark):
        df.write.option("compression", CODEC).option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
