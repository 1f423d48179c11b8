"""Whole listings: every file under a folder, hidden and empty ones too.

Spark's own readers leave out names that begin with ``_`` or ``.`` and files
without bytes. An object store has no such names, so a listing that feeds a
ledger must hold them. Folders are listed in tasks, round by round: a task lists
a folder and what lies under it until it has seen ``ENTRIES`` names, and the
folders it has not come to are spread over the tasks of the next round. A large
tree is listed in parallel, a small one in one round, and the driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.session import ensure_checkpoint_dir
from contrail.sources import fs
from contrail.sources.fs import _by_value, arrow_fs

ENTRIES = 5_000
SCHEMA = "file_key string, is_file boolean, file_size long, mtime_ms long, content_md5 string"


def _lister(digest: bool):
    """Files under the given folders, and the folders (``is_file`` false) still to be listed."""
    to_fs, entries = _by_value(arrow_fs), ENTRIES

    def run(batches):  # runs in Python workers: references nothing of this package
        import hashlib
        from collections import deque

        import pyarrow as pa
        from pyarrow import fs as pafs

        def content_md5(filesystem, path):
            h = hashlib.md5()
            with filesystem.open_input_stream(path) as stream:
                while chunk := stream.read(1 << 20):
                    h.update(chunk)
            return h.hexdigest()

        for batch in batches:
            folders, seen = deque(batch.column("file_key").to_pylist()), 0
            while folders and seen < entries:
                key = folders.popleft().rstrip("/")
                filesystem, top = to_fs(key)
                rows = []
                for info in filesystem.get_file_info(pafs.FileSelector(top or "/", allow_not_found=True)):
                    name = f"{key}/{info.base_name}"
                    if info.type != pafs.FileType.File:
                        folders.append(name)
                        continue
                    rows.append((name, True, info.size or 0, (info.mtime_ns or 0) // 1_000_000,
                                 content_md5(filesystem, info.path) if digest else None))
                seen += len(rows) + 1
                yield table(pa, rows)
            yield table(pa, [(key, False, 0, 0, None) for key in folders])

    def table(pa, rows):
        kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          ["file_key", "is_file", "file_size", "mtime_ms", "content_md5"])
    return run


def list_tree(spark: SparkSession, root: str, digest: bool = False) -> DataFrame:
    """(file_key, file_size, mtime_ms, content_md5) of all files under ``root``; none if it is absent.

    ``file_key`` is the plain path with its scheme. ``content_md5`` is filled
    with ``digest``, which reads every file.
    """
    ensure_checkpoint_dir(spark)
    folders = spark.createDataFrame([(fs.resolved(spark, root),)], "file_key string")
    found = None
    while True:
        width = spark.sparkContext.defaultParallelism
        listed = folders.repartition(width).mapInArrow(_lister(digest), SCHEMA).checkpoint()
        found = listed if found is None else found.unionByName(listed)
        folders = listed.where("NOT is_file").select("file_key")
        if folders.isEmpty():
            return found.where("is_file").drop("is_file")


def visible_copies(files: DataFrame, folder: str) -> DataFrame:
    """(file_key, copy): the files copied by tasks under ``folder``, with names that Spark's readers take."""
    to_fs = _by_value(arrow_fs)

    def run(batches):  # runs in Python workers: references nothing of this package
        import hashlib

        import pyarrow as pa

        for batch in batches:
            keys, copies = batch.column("file_key").to_pylist(), []
            for key in keys:
                copy = folder.rstrip("/") + "/" + hashlib.md5(key.encode()).hexdigest() + "." + key.rsplit(".", 1)[1].lower()
                (source, a), (target, b) = to_fs(key), to_fs(copy)
                target.create_dir(b.rsplit("/", 1)[0], recursive=True)
                with source.open_input_stream(a) as x, target.open_output_stream(b) as y:
                    while chunk := x.read(1 << 20):
                        y.write(chunk)
                copies.append(copy)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(copies, pa.string())], ["file_key", "copy"])
    return files.select("file_key").mapInArrow(run, "file_key string, copy string")


def plain_key(file_path):
    """A reader's ``_metadata.file_path`` (URL-encoded) as the plain path that listings give."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


