"""Small Hadoop FileSystem helpers (metadata only: listing, existence)."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders of ``path`` (empty if absent)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path`` (empty if absent)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file as one string."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_whole(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that appears complete or not at all; False if the name is taken."""
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(draft), fs.makeQualified(p), options)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def resolved(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, mount points followed, as Python's file systems name it."""
    p, fs = _fs(spark, path)
    return (fs.resolvePath(p) if fs.exists(p) else fs.makeQualified(p)).toString()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern``."""
    p, fs = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (a folder this package wrote)."""
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True))


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write job committed ``path`` (``_SUCCESS`` marker)."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (and its parent folders)."""
    p, fs = _fs(spark, path)
    fs.create(p, True).close()


def literal_path(path: str) -> str:
    """``path`` for a Spark reader, its glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def arrow_fs(path: str):
    """(pyarrow FileSystem, path) for a Spark/Hadoop path string.

    Self-contained (imports inside) so that functions shipped to Python
    workers can carry it by value: executors never need this package.
    Local ``file:`` paths map to the local file system.
    """
    import re

    from pyarrow import fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path)
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^s3a?://", "s3://", path))


def _by_value(fn):
    """A copy of module-level ``fn`` that pickles by value (code, not import path)."""
    import types
    return types.FunctionType(fn.__code__, {"__builtins__": __builtins__}, fn.__name__,
                              fn.__defaults__, fn.__closure__)
