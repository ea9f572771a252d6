"""Numbered versions of a small text in a folder: a commit names the version it builds on, and only one writer gets each number.

The text of a version is written beside the folder's versions and renamed to its number, which fails where the number
exists, so a reader never sees half a version and a writer that lost the race notices and can build on the winner's.
File systems whose rename replaces files need a lock of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SUFFIX = ".json"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Committed versions, ascending."""
    fs, at = _fs(spark, folder), _path(spark, folder)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX) and n.removesuffix(_SUFFIX).isdigit())


def read_version(spark: SparkSession, folder: str, version: int) -> str:
    jvm = spark.sparkContext._jvm
    stream = _fs(spark, folder).open(_path(spark, f"{folder}/{version:020d}{_SUFFIX}"))
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_version(spark: SparkSession, folder: str, version: int, text: str) -> bool:
    """Commit ``text`` as ``version``; False if another writer has that number."""
    jvm = spark.sparkContext._jvm
    fs = _fs(spark, folder)
    target, draft = _path(spark, f"{folder}/{version:020d}{_SUFFIX}"), _path(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    if fs.exists(target):
        return False
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), none)
    except Exception as e:  # noqa: BLE001 - only the loss of the race is an answer
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(draft, False)
        return False
    return True


def delete_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
