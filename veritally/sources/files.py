"""Small files and folders on whatever file system a path names, without a Spark job."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _at(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, system = _at(spark, path)
    system.delete(at, True)


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of the entries of a folder; none where there is no folder."""
    at, system = _at(spark, folder)
    if not system.exists(at):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in system.listStatus(at))


def read_text(spark: SparkSession, path: str) -> str:
    at, system = _at(spark, path)
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that readers see whole or not at all; False where there is one already.

    The text goes to a hidden file, which is renamed without leave to overwrite.
    """
    java = spark._jvm.org.apache.hadoop.fs
    target, system = _at(spark, path)
    hidden = java.Path(target.getParent(), f"_{uuid.uuid4().hex}.tmp")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = java.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(getattr(java, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(hidden), context.makeQualified(target), no_options)
    except Exception as error:
        system.delete(hidden, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True
