"""Numbers that only one writer can take, on any Hadoop file system.

A commit is a file that is created once, whole, under a number: ``put_once``
writes it beside its place and moves it there only if nothing stands there (a
hard link on a local file system, elsewhere a rename, which file systems like
HDFS refuse onto a name that is taken). A store whose rename replaces files
gives no such promise and is not fit for two writers at a time.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def listing(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their modification times in ms; none if it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def put_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file with its whole content; False if the name is taken."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    draft = f"_{uuid.uuid4().hex}"
    if fs.getScheme() == "file":
        target = p.toUri().getPath()
        aside = os.path.join(os.path.dirname(target), draft)
        with open(aside, "w", encoding="utf-8") as f:
            f.write(content)
        try:
            os.link(aside, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), draft)
    out = fs.create(aside, False)
    out.write(bytearray(content.encode("utf-8")))
    out.close()
    if not fs.exists(p) and fs.rename(aside, p):
        return True
    fs.delete(aside, False)
    return False


def head(spark: SparkSession, folder: str) -> int:
    """The greatest number taken in a folder, 0 before the first."""
    numbers = [int(m[1]) for n in listing(spark, folder) if (m := re.fullmatch(r"(\d+)\.json", n))]
    return max(numbers, default=0)


def numbered(folder: str, n: int) -> str:
    return f"{folder}/{n:012d}.json"


def take_number(spark: SparkSession, folder: str) -> int:
    """The next free number; of writers at the same time each gets another."""
    n = head(spark, folder) + 1
    while not put_once(spark, numbered(folder, n), ""):
        n += 1
    return n
