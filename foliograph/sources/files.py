"""Small files and folders on shared storage, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; a folder that is not there has none."""
    system, path = _system(spark, folder), _path(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds."""
    _system(spark, path).delete(_path(spark, path), True)


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False, and nothing written, if it is there already.

    The file is renamed into place without overwriting, which is one step on
    file systems with an atomic rename.
    """
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    out = _system(spark, path).create(_path(spark, draft), True)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), conf)
    plain = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, draft), _path(spark, path), plain)
    except Py4JJavaError as exc:
        remove(spark, draft)
        if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
            return False
        raise
    return True
