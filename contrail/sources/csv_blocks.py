"""CSV files of any size, read in blocks by many tasks.

A newline ends a record only outside quotes, and whether a place in a file is
inside quotes depends on everything before it. So a file is read twice. First
every block of a large file is scanned under both assumptions, giving the state
at its end for either state at its beginning; these small tables are composed
along each file. Then every task parses the records that begin in its block,
reading on where the last one ends in a later block. No task holds more than a
block and one record; the header comes from a read of the file's first bytes.

The grammar is that of Python's ``csv``: a quote opens a field only at its
beginning, a doubled quote inside is a quote. Fields go by each file's own
header (of equal names the last counts); absent fields are null, empty text is
empty text, blank lines are skipped and a byte-order mark is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contrail.sources.fs import _by_value, arrow_fs

BLOCK_BYTES = 32 << 20
HEAD_BYTES = 64 << 10
BATCH_ROWS = 5_000


def _scanner():
    """The functions that tasks need, as one self-contained closure."""
    to_fs, head_bytes, batch_rows = _by_value(arrow_fs), HEAD_BYTES, BATCH_ROWS

    def build():  # runs in Python workers: references nothing of this package
        import csv
        import io
        import re
        import sys

        csv.field_size_limit(sys.maxsize)
        opening = re.compile(rb'(?:\A|(?<=[,\n\r]))"')
        opening_or_end = re.compile(rb'\n|(?:\A|(?<=[,\n\r]))"')
        quoted_end = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')

        def end_state(data: bytes, inside: bool) -> bool:
            """Whether ``data``, begun at a record or ``inside`` quotes, ends inside quotes."""
            at = 0
            while True:
                m = quoted_end.match(data, at) if inside else opening.search(data, at)
                if m is None:
                    return inside
                at, inside = m.end(), not inside

        def record_end(data: bytes, inside: bool) -> int:
            """The place after the first newline outside quotes; -1 if there is none."""
            at = 0
            while True:
                m = quoted_end.match(data, at) if inside else opening_or_end.search(data, at)
                if m is None:
                    return -1
                at = m.end()
                if not inside and m[0] == b"\n":
                    return at
                inside = not inside

        def read(file, start: int, length: int) -> bytes:
            file.seek(start)
            return file.read(length)

        def after_newline(file, start: int, size: int) -> int:
            """The place after the first newline at or behind ``start``."""
            while start < size:
                data = read(file, start, head_bytes)
                at = data.find(b"\n")
                if at >= 0:
                    return start + at + 1
                start += len(data)
            return size

        def region(file, block: int, size: int, block_bytes: int) -> tuple[int, int]:
            """Where the block's lines begin, and those of the next."""
            lo, hi = block * block_bytes, (block + 1) * block_bytes
            return (after_newline(file, lo, size) if lo else 0), (after_newline(file, hi, size) if hi < size else size)

        def grown_end(file, start: int, size: int, inside: bool) -> int:
            """The end of the record that ``start`` lies in, reading on as far as needed."""
            length = head_bytes
            while True:
                at = record_end(read(file, start, length), inside)
                if at >= 0:
                    return start + at
                if start + length >= size:
                    return size
                length *= 4

        def records(data: bytes):
            return csv.reader(io.StringIO(data.decode("utf-8", "replace"), newline=""))

        def header(file, size: int) -> tuple[list[str], int]:
            """(names, where the records begin)."""
            start = 3 if read(file, 0, 3) == b"\xef\xbb\xbf" else 0
            while start < size:
                end = grown_end(file, start, size, False)
                names = next(records(read(file, start, end - start)), [])
                if names:
                    return names, end
                start = end
            return [], size

        return end_state, read, region, grown_end, records, header, to_fs, batch_rows
    return build


def _states(blocks: DataFrame, block_bytes: int) -> DataFrame:
    """(file_key, block, inside): whether each block's lines begin inside quotes."""
    build = _scanner()

    def run(batches):
        import pyarrow as pa
        end_state, read, region, _, _, _, to_fs, _ = build()
        for batch in batches:
            rows = batch.to_pylist()
            ends = []
            for r in rows:
                filesystem, path = to_fs(r["file_key"])
                with filesystem.open_input_file(path) as file:
                    a, b = region(file, r["block"], r["file_size"], block_bytes)
                    data = read(file, a, b - a)
                ends.append((end_state(data, False), end_state(data, True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_key"), batch.column("block"), *[pa.array([e[k] for e in ends], pa.bool_()) for k in (0, 1)]],
                ["file_key", "block", "out", "in"])

    ends = blocks.mapInArrow(run, "file_key string, block long, out boolean, in boolean")
    # A few bytes per block; composed in the order of the file.
    inside = F.aggregate(
        "ends", F.array().cast("array<boolean>"),
        lambda got, e: F.array_append(got, F.when(F.size(got) == 0, e["out"])
                                      .otherwise(F.when(F.element_at(got, -1), e["in"]).otherwise(e["out"]))))
    composed = (ends.groupBy("file_key").agg(F.sort_array(F.collect_list(F.struct("block", "out", "in"))).alias("ends"))
                .select("file_key", F.posexplode(inside).alias("block", "inside")))
    return composed.select("file_key", (F.col("block") + 1).cast("long").alias("block"), "inside")


def read_csv(files: DataFrame, columns: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file_key, one text column per name in ``columns``) of the files (file_key, file_size)."""
    build = _scanner()
    blocks = (files.where("file_size > 0")
              .select("file_key", "file_size", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(file_size - 1) div {block_bytes}"))).alias("block")))
    large = blocks.where(F.col("file_size") > block_bytes)
    placed = blocks.join(_states(large, block_bytes), ["file_key", "block"], "left")
    placed = placed.select("file_key", "file_size", "block", F.coalesce("inside", F.lit(False)).alias("inside"))

    def run(batches):
        import itertools

        import pyarrow as pa
        end_state, read, region, grown_end, records, header, to_fs, batch_rows = build()
        for batch in batches:
            for r in batch.to_pylist():
                filesystem, path = to_fs(r["file_key"])
                with filesystem.open_input_file(path) as file:
                    size = r["file_size"]
                    names, begin = header(file, size)
                    a, b = region(file, r["block"], size, block_bytes)
                    inside = r["inside"]
                    if inside:  # a record of an earlier block ends here, or not even here
                        a, inside = grown_end(file, a, size, True), False
                    if a >= b:
                        continue
                    data = read(file, a, b - a)
                    if end_state(data, False) and b < size:
                        b = grown_end(file, b, size, True)
                        data = read(file, a, b - a)
                    data = data[max(0, begin - a):]
                places = [{n: i for i, n in enumerate(names)}.get(c) for c in columns]
                rows = (row for row in records(data) if row)
                while part := list(itertools.islice(rows, batch_rows)):
                    values = [[row[i] if i is not None and i < len(row) else None for row in part] for i in places]
                    yield pa.RecordBatch.from_arrays([pa.array([r["file_key"]] * len(part), pa.string()), *[pa.array(v, pa.string()) for v in values]],
                                                     ["file_key", *columns])

    schema = ", ".join(["file_key string", *[f"`{c}` string" for c in columns]])
    width = files.sparkSession.sparkContext.defaultParallelism
    return placed.repartition(4 * width).mapInArrow(run, schema)
