"""Small file operations on any Hadoop file system: pointers, markers, folder switches."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_system(spark, path).exists(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds; nothing happens if there is none."""
    _system(spark, path).delete(_path(spark, path), True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder of markers or pointers, sorted; none if there is no folder."""
    if not exists(spark, folder):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, folder).listStatus(_path(spark, folder)))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet; False if it does (somebody was first)."""
    try:
        out = _system(spark, path).create(_path(spark, path), False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception) or exists(spark, path):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The first line of a small file ('' if it is empty)."""
    jvm = spark.sparkContext._jvm
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not exist."""
    if exists(spark, target) or not _system(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.replaced"


def recover(spark: SparkSession, path: str) -> None:
    """Undo a switch that stopped between its two renames: the table before it comes back."""
    if not exists(spark, path) and exists(spark, _aside(path)):
        rename(spark, _aside(path), path)


def switch(spark: SparkSession, staged: str, path: str) -> None:
    """Put the complete folder ``staged`` in the place of ``path``.

    The old folder stands aside until the new one is in place, so a stop at any point
    leaves one of them whole (``recover`` brings the old one back).
    """
    recover(spark, path)
    if exists(spark, path):
        delete(spark, _aside(path))
        rename(spark, path, _aside(path))
    rename(spark, staged, path)
    delete(spark, _aside(path))


def beside(path: str) -> str:
    """A new folder name beside ``path`` (the same file system, so it can be renamed)."""
    return f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
