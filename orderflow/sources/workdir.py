"""Scratch locations that every executor can reach."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local session; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", None) or "unknown"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _session_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _session_folder(application: str) -> str:
    """One temporary folder per local session, removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="orderflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the session's part of the shared folder that nothing else uses."""
    return f"{_session_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _session_scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/orderflow/{spark.sparkContext.applicationId}"


def discard_scratch(spark: SparkSession) -> None:
    """Remove all that this session stored on the way, when none of its frames is read any more."""
    if exists(spark, _session_scratch(spark)):
        discard(spark, _session_scratch(spark))


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """A write within this removes its shuffle files when it ends; otherwise they stay until the driver next collects garbage.

    For writes alone: what is written is read from its files from then on, and nobody asks for the shuffle again.
    """
    before = spark.conf.get(_SHUFFLES_GO)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, before)


_TASK_BYTES = "spark.sql.files.maxPartitionBytes"
# Compressed columns of wide rows that take a few hundred megabytes once they are rows.
SORTED_BYTES = 8 * 1024 * 1024


@contextmanager
def small_tasks(spark: SparkSession, size: int = SORTED_BYTES) -> Iterator[None]:
    """A scan that runs within this reads at most ``size`` bytes of files a task, so that the task can sort its rows in memory."""
    before = spark.conf.get(_TASK_BYTES)
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(_TASK_BYTES, str(min(size, now)))
    try:
        yield
    finally:
        spark.conf.set(_TASK_BYTES, before)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back: a lineage cut that outlives executors."""
    path = fresh_dir(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """``stored``, and what the write itself counted: no pass of its own."""
    seen = Observation()
    rows = stored(df.observe(seen, *metrics), name)
    return rows, seen.get


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    _filesystem(spark, path).delete(_path(spark, path), True)


def exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is not there."""
    if not exists(spark, path):
        return []
    return [f.getPath().getName() for f in _filesystem(spark, path).listStatus(_path(spark, path))]


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there, or goes away just before it is opened."""
    if not exists(spark, path):
        return None
    try:
        stream = _filesystem(spark, path).open(_path(spark, path))
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.io.FileNotFoundException":
            raise
        return None
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _beside(spark: SparkSession, path: str, text: str):
    """A file with the text next to ``path``, under a name that nothing else uses."""
    place = _path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    out = _filesystem(spark, path).create(place, False)
    out.write(bytearray(text.encode()))
    out.close()
    return place


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Whether ``path`` came into being with this text, at once and whole; False if it was there already.

    The text is written under another name, which then becomes ``path`` unless that exists: a hard link on local disks, a rename that
    does not overwrite elsewhere. It is as exclusive as the store's rename; on object stores run one writer at a time.
    """
    files, place = _filesystem(spark, path), _path(spark, path)
    if files.getUri().getScheme() == "file":
        name = place.toUri().getPath()
        os.makedirs(os.path.dirname(name), exist_ok=True)
        written = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}.tmp"
        try:
            with open(written, "x", encoding="utf-8") as out:
                out.write(text)
                out.flush()
                os.fsync(out.fileno())
            os.link(written, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(written)
        return True
    written = _beside(spark, path, text)
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(written, place, options)
    except Py4JJavaError:
        if not files.exists(place):
            raise
        files.delete(written, False)
        return False
    return True


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file's text set anew; for hints, since a reader may find none for a moment."""
    files, place = _filesystem(spark, path), _path(spark, path)
    written = _beside(spark, path, text)
    files.delete(place, False)
    if not files.rename(written, place):
        files.delete(written, False)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
