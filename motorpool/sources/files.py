"""Path checks and small files through Spark's own file systems (local, HDFS, object stores)."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def listing(spark: SparkSession, path: str) -> list[Entry]:
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return [
        Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(target)
    ]


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.mkdirs(target)


def drop(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that must not exist yet; False if it does. Atomic where the file system is."""
    fs, target = _locate(spark, path)
    fs.mkdirs(target.getParent())
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(target):
            return False
        raise
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    return True


def _local(spark: SparkSession, path: str) -> Path | None:
    """The path on the driver's own disk, None on other file systems."""
    fs, target = _locate(spark, path)
    return Path(target.toUri().getPath()) if fs.getUri().getScheme() == "file" else None


def _beside(place: Path, content: dict) -> Path:
    place.parent.mkdir(parents=True, exist_ok=True)
    beside = place.with_name(f".{place.name}.{uuid.uuid4().hex}")
    beside.write_text(json.dumps(content, sort_keys=True), encoding="utf-8")
    return beside


def create_whole(spark: SparkSession, path: str, content: dict) -> bool:
    """Make a JSON file that must not exist yet, complete from its first moment; False if it does.

    Exactly one of several callers gets True: HDFS refuses to rename over a file. Local disks are only asked whether
    it exists before they rename, so there a hard link, which the system refuses, makes it.
    """
    place = _local(spark, path)
    if place:
        beside = _beside(place, content)
        try:
            os.link(beside, place)
        except FileExistsError:
            return False
        finally:
            beside.unlink()
        return True
    try:
        _rename(spark, path, content, overwrite=False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or exists(spark, path):
            return False
        raise
    return True


def read_json(spark: SparkSession, path: str) -> dict | None:
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def replace_json(spark: SparkSession, path: str, content: dict) -> None:
    """Write beside the target, then rename over it, so a reader sees the old or the new content."""
    place = _local(spark, path)
    if place:
        # Hadoop deletes a local target before it renames; a checksum it left would not fit the new content
        place.with_name(f".{place.name}.crc").unlink(missing_ok=True)
        os.replace(_beside(place, content), place)
        return
    _rename(spark, path, content, overwrite=True)


def _rename(spark: SparkSession, path: str, content: dict, overwrite: bool) -> None:
    fs, target = _locate(spark, path)
    fs.mkdirs(target.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(beside, fs.makeQualified(target), options)
    except Py4JJavaError:
        fs.delete(beside, False)
        raise
