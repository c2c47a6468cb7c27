"""Small control files on any file system Spark can reach (HDFS, object stores, local)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; empty when there is none."""
    fs, target = _fs(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return read_bytes(spark, path).decode("utf-8")


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def _write(fs, target, content: bytes, overwrite: bool) -> None:
    stream = fs.create(target, overwrite)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def create_bytes(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create a file with this content, whole or not at all; False when it exists already.

    Where a new file is visible before it is filled, the content goes to a temporary file that
    takes the name in one step, without replacing another. Object stores show a new object
    when it is complete; whether two creators of one name can both win there depends on the
    store (`fs.s3a.create.conditional.enabled` and the like).
    """
    fs, target = _fs(spark, path)
    scheme = fs.getUri().getScheme()
    if scheme not in ("file", "hdfs", "viewfs"):
        try:
            _write(fs, target, content, False)
        except Exception as error:  # Py4J wraps FileAlreadyExistsException
            if "already exists" in str(error) or "AlreadyExists" in str(error):
                return False
            raise
        return True
    folder = target.getParent()
    fs.mkdirs(folder)
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{uuid.uuid4().hex}.tmp")
    _write(fs, temporary, content, False)
    try:
        if scheme != "file":
            return fs.rename(temporary, target)  # never replaces a file
        try:
            os.link(temporary.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        if fs.exists(temporary):
            fs.delete(temporary, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file, replacing what is there."""
    fs, target = _fs(spark, path)
    _write(fs, target, text.encode("utf-8"), True)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of the last change of a file, or of the newest file of a folder."""
    fs, target = _fs(spark, path)
    times = [fs.getFileStatus(target).getModificationTime()]
    times += [s.getModificationTime() for s in (fs.listStatus(target) or [])]
    return max(times) / 1000


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    return create_bytes(spark, path, text.encode("utf-8"))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)
