"""Files that tasks open by URI, through Arrow's file systems."""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

_URI = re.compile(r"([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?(.*)", re.DOTALL)
#: Schemes whose stores tasks can open without Spark.
SCHEMES = frozenset({"file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"})


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a whole URI on its own file system; a path without a scheme
    lies on the session's default one (a relative one, where that is the local
    disk, in this process's folder)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not _URI.fullmatch(path) and fs.getScheme() == "file":
        where = spark._jvm.org.apache.hadoop.fs.Path(os.path.abspath(path))
    return fs.makeQualified(where).toString().rstrip("/")


def parts(uri: str) -> tuple[str, str, str]:
    """Scheme, authority and path of a URI (``file`` without one)."""
    m = _URI.fullmatch(uri)
    return (m[1], m[2] or "", m[3]) if m else ("file", "", uri)


def reaches(uri: str) -> bool:
    return parts(uri)[0] in SCHEMES


def opened(uri: str):
    """The Arrow file system of a URI, and its path there (taken as it stands:
    Spark's paths are not escaped)."""
    import pyarrow.fs as pafs

    scheme, authority, path = parts(uri)
    if scheme == "file":
        return pafs.LocalFileSystem(), path
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, f"{base.rstrip('/')}{path}"
