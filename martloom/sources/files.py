"""Small file operations on any file system Spark can reach, without a Spark job."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, hidden ones left out; none if it is not there."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a path that hold data: the file itself, or those of the folder."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return []
    if fs.getFileStatus(target).isFile():
        return [path] if fs.getFileStatus(target).getLen() else []
    inner = [s for s in fs.listStatus(target) if s.isFile() and s.getLen()]
    return sorted(s.getPath().toString() for s in inner if not s.getPath().getName().startswith(("_", ".")))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file; compressed files are told by their name."""
    fs, target = _at(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(target)
    stream = fs.open(target)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text, None if it is not there."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: under another name first, then renamed."""
    fs, target = _at(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot write {path}")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.mkdirs(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not be there, its parent is made."""
    fs, here = _at(spark, source)
    there = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(there.getParent())
    if not fs.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")
