"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spare_memory(spark: SparkSession) -> None:
    """Keep what Python work takes beside the heap small, for jobs that send whole texts to it.

    An executor keeps its workers, some 200 MB each, in a pool per environment. Short tracebacks are a setting that
    reaches the environment of some kinds of Python work only, which makes two pools. Lots of texts are held by the
    JVM and by a worker, so they have fewer rows than Spark's default of 10,000.
    """
    spark.conf.set("spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def sql_strings(values: Sequence[str]) -> str:
    """The values as quoted SQL strings, with every special character escaped."""
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return ", ".join(f"'{v}'" for v in quoted)


def small(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that little is held as Python objects at a time."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
