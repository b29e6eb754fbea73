"""Binary files in the shared folder, written and read inside tasks.

Files go through Arrow's file systems, by URI, so that a folder can be local,
HDFS or an object store. A task writes under a name of its own; only files
named in the rows that a finished task returns count, so that what a lost or
repeated task left behind is never read.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's URI: without a scheme it is in Spark's default file system, which tasks do not know."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    if whole.getScheme() == "file":
        return f"file://{whole.getPath()}"
    return whole.toString()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a plain local path."""
    return fs.FileSystem.from_uri(uri) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", uri) else (fs.LocalFileSystem(), uri)


def new_file(folder: str, stem: str, suffix: str) -> tuple[str, object]:
    """URI of a file that no other task writes, and a stream to write it."""
    uri = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, path = opened(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def read_file(uri: str):
    """A file for random reads."""
    system, path = opened(uri)
    return system.open_input_file(path)
