"""Versions of a set of tables: written aside, and published by one small file.

A version is a folder of its own. Its number is a file that holds the folder's name, made
only after everything in the folder is written, and never overwritten: a reader sees a whole
version or none, a write that fails leaves the ones before it, and of two that publish at a
time each gets a number.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 9


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def new_version(path: str) -> str:
    """A folder for the tables of a version to come."""
    return f"{path}/data/{uuid.uuid4().hex}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions, oldest first."""
    store, place = _store(spark, f"{path}/versions")
    if not store.exists(place):
        return []
    # A file without content belongs to a publisher that was cut off.
    return sorted(int(f.getPath().getName()) for f in store.listStatus(place) if f.getLen() and f.getPath().getName().isdigit())


def publish(spark: SparkSession, path: str, folder: str) -> int:
    """Make a written folder the newest version; its number."""
    number = max(versions(spark, path), default=0)
    while True:
        number += 1
        store, place = _store(spark, f"{path}/versions/{number:0{DIGITS}d}")
        try:
            out = store.create(place, False)
        except (Py4JJavaError, PySparkException):
            if not store.exists(place):
                raise
            continue  # taken by another publisher, or left by one
        out.write(bytearray(folder.rpartition("/")[2].encode()))
        out.close()
        return number


def folder_of(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Where the tables of a version are, the newest if none is named."""
    known = versions(spark, path)
    number = version if version is not None else max(known, default=None)
    if number not in known:
        raise ValueError(f"no version {number} in {path}: there are {known}")
    store, place = _store(spark, f"{path}/versions/{number:0{DIGITS}d}")
    size = store.getFileStatus(place).getLen()
    stream = store.open(place)
    name = "".join(chr(stream.read()) for _ in range(size))
    stream.close()
    return f"{path}/data/{name}"
