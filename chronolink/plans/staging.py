"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_scopes: list[list[str]] = []


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was staged inside; for jobs that have written their result by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        jvm = spark.sparkContext._jvm
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it: it gets a folder of its own, removed at exit.
    On a cluster a machine-local folder would not be seen by other executors, so that is an error.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="chronolink-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the staging folder that no other run uses."""
    return f"{staging_root(spark)}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    Cuts the lineage: every later branch reads the same rows, in files that outlive any executor.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
