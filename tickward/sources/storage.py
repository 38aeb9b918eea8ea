"""Folders on whatever file system Spark uses."""

from __future__ import annotations

import os
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Object stores in which renaming is copying and only a conditional write is exclusive.
OBJECT_STORES = ("s3", "s3a", "s3n")
CONDITIONAL = "fs.option.create.conditional.overwrite"
#: Of what is written as Parquet. Ids are hexadecimal digests and texts much alike, which zstd halves and Spark's default leaves as they are.
CODEC = "zstd"


class Entry(NamedTuple):
    name: str
    modified: float  # seconds since the epoch


def _fs(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    fs, path = _fs(spark, name)
    return fs.exists(path)


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What a folder holds, by one listing; nothing if there is no such folder."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(Entry(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(path))


def make_folder(spark: SparkSession, name: str) -> None:
    fs, path = _fs(spark, name)
    fs.mkdirs(path)


def create_new(spark: SparkSession, name: str) -> bool:
    """Create an empty file of a name nobody else uses; whether this call made it."""
    fs, path = _fs(spark, name)
    return fs.createNewFile(path)


def read_text(spark: SparkSession, name: str) -> str:
    fs, path = _fs(spark, name)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, name: str, text: str) -> bool:
    """Create a file with its whole content unless there is one of that name; whether this call made it.

    Of several callers one succeeds, and no reader sees half a file. The local file system links a finished file, object stores write on
    the condition that there is nothing yet, others rename a finished file, which fails if the name is taken. A store without
    any of these is refused, since two writers would both believe to be first.
    """
    make_folder(spark, name.rpartition("/")[0])
    fs, path = _fs(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(fs.resolvePath(path.getParent()), path.getName())
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme = fs.getUri().getScheme()
    if scheme in OBJECT_STORES:
        return _put_if_absent(fs, path, text, scheme)
    made = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}")
    if scheme == "file":
        unfinished, final = made.toUri().getPath(), path.toUri().getPath()
        with open(unfinished, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(unfinished, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(unfinished)
        return True
    _write(fs.create(made, True), text)
    if fs.rename(made, path):
        return True
    fs.delete(made, False)
    return False


def _write(stream, text: str) -> None:
    stream.write(text.encode())
    stream.close()


def _put_if_absent(fs, path, text: str, scheme: str) -> bool:
    if not fs.hasPathCapability(path, CONDITIONAL):
        raise ValueError(f"{scheme} is not set up for conditional writes, which a table of commits needs")
    if fs.exists(path):
        return False
    try:
        _write(fs.createFile(path).overwrite(True).must(CONDITIONAL, True).build(), text)
    except Py4JJavaError:
        if fs.exists(path):  # another writer was first
            return False
        raise
    return True


def delete(spark: SparkSession, name: str) -> None:
    fs, path = _fs(spark, name)
    fs.delete(path, True)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Empty table that the optimizer knows to be empty, so that joins with it fold away."""
    return spark.createDataFrame([], schema).limit(0)
