"""Small files on the cluster's storage, through Hadoop's file systems (HDFS, object stores, file://)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *(p.strip("/") for p in parts)])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def make_dirs(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if there is no folder."""
    if not exists(spark, folder):
        return []
    return [f.getPath().getName() for f in _fs(spark, folder).listStatus(_path(spark, folder))]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    _fs(spark, path).delete(_path(spark, path), True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole unless there is one of that name; whether it was written.

    The rename is atomic on file systems that rename atomically (HDFS); elsewhere a lock is needed.
    """
    side = _write_beside(spark, path, text)
    try:
        _rename(spark, side, path, overwrite=False)
    except Py4JJavaError as exc:
        delete(spark, side)
        if "FileAlreadyExists" in str(exc.java_exception):
            return False
        raise
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old or the new text, never a part.

    The text goes to a file beside the target, which then replaces it by rename.
    """
    _rename(spark, _write_beside(spark, path, text), path, overwrite=True)


def _write_beside(spark: SparkSession, path: str, text: str) -> str:
    folder, _, name = path.rpartition("/")
    side = f"{folder}/.{name}.{uuid.uuid4().hex}"
    stream = _fs(spark, side).create(_path(spark, side), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return side


def _rename(spark: SparkSession, side: str, path: str, overwrite: bool) -> None:
    jvm = spark.sparkContext._jvm
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.valueOf("OVERWRITE" if overwrite else "NONE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _fs(spark, path).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(_path(spark, side), _path(spark, path), options)
