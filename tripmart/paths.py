"""Small file operations on whatever file system a path names (local, HDFS, object store)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder."""
    fs, target = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def plain(spark: SparkSession, address: str) -> str:
    """A path out of an address with escapes, as listings and file metadata give it."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(address)).toString()


def below(spark: SparkSession, root: str, addresses: list[str]) -> list[str]:
    """Where files lie below a folder, out of their addresses."""
    fs, target = _file_system(spark, root)
    start = fs.makeQualified(target).toString().rstrip("/") + "/"
    found = []
    for address in addresses:
        path = plain(spark, address)
        if not path.startswith(start):
            raise ValueError(f"{path} is not below {root}")
        found.append(path.removeprefix(start))
    return found


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# File systems whose rename swaps a file in one step. Elsewhere, on object
# stores, a rename is delete and copy, but a single put replaces a file in one step.
ATOMIC_RENAME = {"file", "hdfs", "viewfs", "webhdfs"}


def _put(fs, target, text: str) -> None:
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old or the new content, never a part."""
    jvm = spark.sparkContext._jvm
    fs, target = _file_system(spark, path)
    if fs.getUri().getScheme() not in ATOMIC_RENAME:
        _put(fs, target, text)
        return
    staged = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    _put(fs, staged, text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(context.makeQualified(staged), context.makeQualified(target), options)
