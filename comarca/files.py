"""Folders and small documents in whatever store Spark knows by their path, never in a process's own file system."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. Only in local mode (tests) one is set where none is."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder: executors need one that they share")
        path = tempfile.mkdtemp(prefix="checkpoints-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def held(frame: DataFrame) -> DataFrame:
    """A small aggregate, computed once and kept in the shared folder: what is built on it reads it there, not the fact again."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; what is not there is no error."""
    place, store = _place(spark, path)
    store.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small document whole, over an earlier one; folders are made as needed."""
    place, store = _place(spark, path)
    out = store.create(place, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small document; null where there is none."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return None
    source = store.open(place)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of what lies in a folder, by name; a file stands for itself, and nothing for what is not there."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return []
    return sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in store.listStatus(place))


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; none where there is none."""
    place, store = _place(spark, path)
    return store.getContentSummary(place).getLength() if store.exists(place) else 0
