"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Rows and bytes of the Arrow batches that Spark sends to Python.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Rows taken from an Arrow batch at a time, so that few texts are Python objects at once.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bounds rows and bytes of the session's Arrow batches, so that long texts don't fill executors; lower bounds stay.

    The setting belongs to the session and is read when a plan runs, so the job that owns the session asks
    for it (the queries and the pipeline do); operators leave settings alone.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(re.sub(r"\D", "", spark.conf.get(f"spark.sql.execution.arrow.{name}")) or 0)
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow``; see ``bounded_batches`` for the size of its batches."""
    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_dir()


@lru_cache(maxsize=1)
def _own_dir() -> str:
    folder = tempfile.mkdtemp(prefix="attesta-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


#: What to undo for intermediate results, by the innermost open ``scratch``; the first list lasts until the process ends.
_undo: list[list[Callable[[], None]]] = [[]]


def _run_undo(steps: list[Callable[[], None]]) -> None:
    while steps:
        step = steps.pop()
        try:
            step()
        except Exception:  # noqa: BLE001  (the session may be gone; the next step may still work)
            continue


atexit.register(lambda: _run_undo(_undo[0]))


@contextmanager
def scratch() -> Iterator[None]:
    """Intermediate tables and persisted data that operators make inside are dropped at the end.

    For callers that have written what they wanted by then: lazy results of the operators read the tables.
    Without it they go when the process ends.
    """
    _undo.append([])
    try:
        yield
    finally:
        _run_undo(_undo.pop())


def until_done(step: Callable[[], None]) -> None:
    """Runs ``step`` when the innermost ``scratch`` or the process ends."""
    _undo[-1].append(step)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there, and a lost executor costs nothing."""
    table, path = write_table(df, label)
    until_done(lambda: remove_table(df.sparkSession, path))
    return table


def write_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The written table and its path, for ``remove_table``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more, in whatever store holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a longer name where ``df`` has such a column already (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish
