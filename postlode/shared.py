"""The folder that all executors share, tables written to it, and batch helpers for Arrow functions."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where none is set, one of this machine, if all of Spark runs on it; else an error."""
    if not (folder := spark.conf.get("spark.checkpoint.dir", None)):
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not current.isDefined():
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="postlode-"))
            current = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = current.get()
    return folder.rstrip("/")


#: Folders that stored() and checkpointed() have written, in order, for drop_stored().
WRITTEN: list[str] = []
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def written() -> Iterator[list[str]]:
    """The folders that this thread writes inside; those of other threads are not among them."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)


def wrote(path: str) -> None:
    """Notes a folder that a function has written, for written() and drop_stored()."""
    WRITTEN.append(path)
    for paths in _SCOPES.get():
        paths.append(path)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes what the writes inside shuffle as soon as each ends, not when the driver's memory is next cleaned."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint: lineage is cut, lost executors lose nothing. drop_stored() deletes it."""
    shared_folder(df.sparkSession)
    with _shuffles_dropped(df.sparkSession):
        # a frame made here: the setting counts when a frame is made
        kept = df.select("*").checkpoint()
    if (file := kept._jdf.queryExecution().logical().rdd().getCheckpointFile()).isDefined():
        wrote(file.get())
    return kept


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, noted as one that drop_stored() deletes."""
    path = f"{shared_folder(spark)}/postlode-{name}-{uuid.uuid4().hex}"
    wrote(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to the shared folder, and read from there."""
    spark, path = df.sparkSession, folder(df.sparkSession, name)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Deletes what stored() and checkpointed() have written, or those of it alone that are in `paths`; results that still read it are lost."""
    hadoop, chosen = spark._jvm.org.apache.hadoop.fs, None if paths is None else set(paths)
    for path in [p for p in WRITTEN if chosen is None or p in chosen]:
        place = hadoop.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        WRITTEN.remove(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose `column` holds about most_bytes at most (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a table that a DDL string describes; a session must run."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))
