"""Written intermediate tables in the shared folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from panelforge.session import scratch_path

#: The tables of the ``own_tables`` blocks, outermost first, as (session, path).
_OWN: ContextVar[tuple[list[tuple[SparkSession, str]], ...]] = ContextVar("own", default=())


@contextmanager
def own_tables() -> Iterator[None]:
    """Tables written inside are deleted at the end, also after a failure; those written with ``keep`` at the end of the block around it, if any."""
    own: list[tuple[SparkSession, str]] = []
    token = _OWN.set((*_OWN.get(), own))
    try:
        yield
    finally:
        _OWN.reset(token)
        for spark, path in own:
            _delete(spark, path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Steps that run inside hand Python batches of about ``size``, which a task holds on both sides."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps; what a first pass finalises, a second one frees."""
    for pause in (0.2, 0.1):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``keep``: the table outlives the ``own_tables`` block that it is written in, as the caller's result reads it.

    Cuts lineage like checkpoint(), but columnar and compressed; every executor
    and a restarted one can read it again.  Shuffle files of earlier steps that
    nothing refers to any more are released first.
    """
    spark = df.sparkSession
    release(spark)
    path = scratch_path(spark, name)
    blocks = _OWN.get()[:-1] if keep else _OWN.get()
    if blocks:
        blocks[-1].append((spark, path))
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a ``written`` table that nothing will read again."""
    files = df.inputFiles()
    if files:
        _delete(df.sparkSession, files[0].rsplit("/", 1)[0])


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
