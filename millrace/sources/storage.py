"""Listing and deleting folders through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that hold something; one that is being written does not yet."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile() and s.getLen())


def child_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the files in each folder of ``path``."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return {}
    return {s.getPath().getName(): sum(f.getLen() for f in fs.listStatus(s.getPath())) for s in fs.listStatus(target) if s.isDirectory()}


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole, as UTF-8."""
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file; without ``replace`` an existing one stays and the answer is False.

    The creation is the file system's own, so of several writers one creates it.
    """
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    try:
        stream = fs.create(target, replace)
    except Exception as error:
        if not replace and fs.exists(target):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)
