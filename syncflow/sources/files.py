"""Small file-system helpers (any file system Hadoop can reach).

Only metadata passes through these calls: path names, and commit records of a
few kilobytes. Rows never do.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def make_scratch(spark: SparkSession, path: str) -> None:
    """Make a folder that goes away with the application at the latest."""
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty if there is no such directory."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def size(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path``."""
    fs, jpath = _fs(spark, path)
    return fs.getContentSummary(jpath).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file so that readers see all of it or none of it."""
    fs, final = _fs(spark, path)
    if fs.exists(final):
        raise FileExistsError(path)
    _, draft = _fs(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(draft, final):
        raise FileExistsError(path)


def create_note(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that does not exist yet; false if somebody else did."""
    fs, jpath = _fs(spark, path)
    if fs.exists(jpath):
        return False
    try:
        stream = fs.create(jpath, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return True
