"""Small files of ours beside the tables, through the file system that a path belongs to."""
from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_json(spark: SparkSession, path: str, value: dict, replace: bool = False) -> None:
    """The value as one file.  Without ``replace`` a file that is already there raises
    ``FileExistsError``: of two writers one wins."""
    fs, p = _at(spark, path)
    try:
        out = fs.create(p, replace)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise FileExistsError(path) from e
        raise
    out.write(bytearray(json.dumps(value).encode()))
    out.close()


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The file's value; None if there is no such file, or only the beginning of one."""
    if not exists(spark, path):
        return None
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    try:
        return json.loads(text)
    except ValueError:
        return None
