"""Incremental multi-format file ingestion with a ledger, published as one.

``ingest_files`` loads every json / ndjson / csv / parquet file under a
folder into a Parquet target table, once per (target, file, etag):

1. list the whole folder in tasks, hidden and empty files too (``listing``);
2. keep the four formats; ``file_type`` narrows them (``json`` also takes
   ndjson; the type is trimmed, lower-cased and leading dots dropped);
3. skip files whose (target, key, etag) is SUCCESS in the ledger; FAILED
   files are tried again, and a changed file (new etag) loads again;
4. read each format with every column as text, so a value that does not fit
   its target type is traced to its file: JSON and Parquet by Spark's readers,
   CSV in blocks (``csv_blocks``);
5. judge each file: any bad value, unparsable record, unreadable footer or
   page, or a JSON or Parquet file without bytes fails it as a whole;
6. read the good files again and write their rows under ``run=<id>``, and the
   ledger rows (SUCCESS / FAILED with a message) under a ``run=<id>`` of the
   ledger; the current state of a key is its newest row;
7. publish both by one manifest (``manifest``). Readers take published runs, so
   a run that stops anywhere leaves nothing behind that anyone reads, and of two
   runs at once the second starts over.

Target columns that are not loaded may have defaults: ``NOW`` (the run's time)
and ``SERIAL`` (numbers that go on from run to run, by file and place in it).

Returns one row ``(files_processed, files_skipped, files_failed)``.
Spark has no object-store ETag, so ``etag`` is ``size-mtime`` by default or
the MD5 of the content (``etag_mode="md5"``, reads every listed file).
The driver only ever holds file paths (in batches), never rows.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contrail import schemas
from contrail.functions.casts import NUMBER_RE
from contrail.functions.time import ntz_literal
from contrail.session import ensure_checkpoint_dir, work_dir
from contrail.sources import fs, manifest
from contrail.sources.csv_blocks import BLOCK_BYTES, read_csv
from contrail.sources.fs import _by_value, arrow_fs
from contrail.sources.listing import list_tree, plain_key, visible_copies

# Accepted formats, identifier rules and the ledger statuses.
FORMATS = ("json", "ndjson", "csv", "parquet")
TABLE_RE = r"^[a-zA-Z_][a-zA-Z0-9_]*(\.[a-zA-Z_][a-zA-Z0-9_]*)?$"
COLUMN_RE = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
SUCCESS, FAILED = "SUCCESS", "FAILED"
CORRUPT = "_corrupt_record"
# Defaults of target columns that are not loaded.
NOW, SERIAL = "now", "serial"

# File names the driver holds at a time; a run of more files reads them batch by batch and still publishes once.
MAX_FILES_PER_BATCH = 50_000
TRIES = 5


def validate(target_table: str, columns: str | list[str]) -> list[str]:
    """Check identifiers before any job runs; returns the column list."""
    listed = columns.split(",") if isinstance(columns, str) else list(columns)
    wanted = list(filter(None, map(str.strip, listed)))
    odd = [name for name in wanted if re.match(COLUMN_RE, name) is None]
    if re.match(TABLE_RE, target_table) is None:
        raise ValueError(f"{target_table!r} cannot name a table")
    if odd or not wanted:
        raise ValueError(f"cannot name columns: {odd}" if odd else "no columns named")
    return wanted


def is_table_name(name: Column) -> Column:
    """``validate``'s rule for target tables, for a column of names."""
    return name.rlike(TABLE_RE)


def is_column_name(name: Column) -> Column:
    return name.rlike(COLUMN_RE)


def normalize_type(file_type: str) -> str:
    return file_type.lower().strip().lstrip(".")


def takes(file_type: str, ext: str) -> bool:
    """Whether files of extension ``ext`` are loaded for a requested type."""
    requested = normalize_type(file_type)
    return ext in FORMATS and (requested in ("all", ext) or (requested, ext) == ("json", "ndjson"))


def list_files(spark: SparkSession, path: str, file_type: str = "all",
               etag_mode: str = "meta") -> DataFrame:
    """Accepted files under ``path``: file_key, ext, file_size, etag."""
    if etag_mode not in ("meta", "md5"):
        raise ValueError(f"unknown etag mode {etag_mode!r}")
    found = list_tree(spark, path, digest=etag_mode == "md5")
    # As os.path.splitext: the dots a name begins with start no extension.
    ext = F.lower(F.regexp_extract("file_key", r"[^/.][^/]*\.([^./]+)$", 1))
    if etag_mode == "meta":
        etag = F.concat_ws("-", F.col("file_size").cast("string"), F.col("mtime_ms").cast("string"))
    else:
        etag = F.col("content_md5")
    out = found.select("file_key", ext.alias("ext"), "file_size", etag.alias("etag"))
    return out.where(F.col("ext").isin([e for e in FORMATS if takes(file_type, e)]))


def _published(spark: SparkSession, root: str, runs: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the published runs' folders under ``root``."""
    folders = [f"{root.rstrip('/')}/run={r}" for r in runs]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    runs = manifest.newest(spark, ledger_path).state.get("ledger", [])
    return _published(spark, ledger_path, runs, schemas.LEDGER)


def read_target(spark: SparkSession, target_path: str, ledger_path: str, schema: T.StructType) -> DataFrame:
    """The target's rows, as far as the ledger's manifest has published them."""
    runs = manifest.newest(spark, ledger_path).state.get("targets", {}).get(_folder(spark, target_path), [])
    return _published(spark, target_path, runs, schema)


def _folder(spark: SparkSession, path: str) -> str:
    return fs.resolved(spark, path).rstrip("/")


def discard_unpublished(spark: SparkSession, target_path: str, ledger_path: str) -> int:
    """Delete what stopped runs left behind; returns the number of folders. Not while a run goes on."""
    state = manifest.newest(spark, ledger_path).state
    kept = {target_path: state.get("targets", {}).get(_folder(spark, target_path), []), ledger_path: state.get("ledger", [])}
    spare = [f"{root.rstrip('/')}/{name}" for root, runs in kept.items() for name in fs.list_dirs(spark, root)
             if name.startswith("run=") and name[4:] not in runs]
    for path in spare:
        fs.delete(spark, path)
    return len(spare)


def current_ledger(ledger: DataFrame) -> DataFrame:
    """Newest row per (target_table, file_key, etag): the upserted state."""
    keys = ["target_table", "file_key", "etag"]
    rest = [c for c in ledger.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.col("loaded_at"))
    return ledger.groupBy(*keys).agg(latest.alias("_s")).select(*keys, *[F.col("_s." + c).alias(c) for c in rest])


def _read_text_columns(spark: SparkSession, ext: str, files: DataFrame, paths: list[str], cols: list[str],
                       csv_block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of the given files: file_key, one text column per target column, whether it was unparsable.

    Parquet files come in groups of one type per target column; pages that
    cannot be read end their file early, which its footer's count tells.
    """
    if ext == "csv":
        return read_csv(files, cols, csv_block_bytes).withColumn("_corrupt", F.lit(False))
    literal = list(map(fs.literal_path, paths))
    if ext == "parquet":
        df = spark.read.option("ignoreCorruptFiles", "true").parquet(*literal)
        corrupt = F.lit(False)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols]
                              + [T.StructField(CORRUPT, T.StringType())])
        df = (spark.read.schema(schema).option("multiLine", str(ext == "json").lower())
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(literal))
        corrupt = F.col(CORRUPT).isNotNull()
    present = set(df.columns)
    values = [(F.col(c) if c in present else F.lit(None)).cast("string").alias(c) for c in cols]
    return df.select(plain_key(F.col("_metadata.file_path")).alias("file_key"), *values, corrupt.alias("_corrupt"))


def _bad_value(c: str, dtype: T.DataType):
    x = F.col(c)
    bad = x.try_cast(dtype).isNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        bad = bad | ~x.rlike(NUMBER_RE)  # the cast alone takes type suffixes
    return x.isNotNull() & bad


def ingest_files(spark: SparkSession, target_table: str, target_schema: T.StructType,
                 columns: str | list[str], path: str, target_path: str, ledger_path: str,
                 file_type: str = "all", etag_mode: str = "meta",
                 now: datetime | None = None, defaults: dict[str, str] | None = None,
                 csv_block_bytes: int = BLOCK_BYTES) -> DataFrame:
    cols = validate(target_table, columns)
    ensure_checkpoint_dir(spark)
    names = [f.name for f in target_schema.fields]
    missing = [c for c in [*cols, *(defaults or {})] if c not in names]
    if missing:
        raise ValueError(f"columns not in target schema: {missing}")
    if set((defaults or {}).values()) - {NOW, SERIAL}:
        raise ValueError(f"defaults are {NOW!r} or {SERIAL!r}")
    load = Load(spark, target_table, target_schema, cols, target_path, ledger_path,
                 {c: d for c, d in (defaults or {}).items() if c not in cols},
                 now or datetime.now(timezone.utc).replace(tzinfo=None), csv_block_bytes)
    for last in range(TRIES):
        try:
            counts = load.run(path, file_type, etag_mode)
            break
        except manifest.Conflict:  # another run has published: look again at what is left to do
            if last == TRIES - 1:
                raise
    return spark.createDataFrame([counts], "files_processed int, files_skipped int, files_failed int")


def _parquet_footers(files: DataFrame, cols: list[str]) -> DataFrame:
    """(file_key, kind, footer_rows, error_message) per Parquet file; ``kind`` names the types of ``cols``.

    Footers are read inside tasks (pyarrow, distributed over the files), so a
    truncated or non-Parquet file fails alone, and files of different column
    types are read apart. Only Parquet-format errors count as the file's own.
    """
    to_fs = _by_value(arrow_fs)

    def check(batches):  # runs in Python workers: references nothing of this package
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        for pdf in batches:
            found = []
            for key in pdf["file_key"]:
                try:
                    filesystem, path = to_fs(key)
                    with filesystem.open_input_file(path) as f:
                        file = pq.ParquetFile(f)
                        types = {n: str(t) for n, t in zip(file.schema_arrow.names, file.schema_arrow.types)}
                        found.append((key, ", ".join(f"{c} {types.get(c)}" for c in cols), file.metadata.num_rows, None))
                except pa.ArrowInvalid as e:
                    found.append((key, None, None, f"unreadable parquet file: {e}"))
            yield pd.DataFrame(found, columns=["file_key", "kind", "footer_rows", "error_message"]).astype({"footer_rows": "Int64"})
    return files.select("file_key").mapInPandas(
        check, "file_key string, kind string, footer_rows long, error_message string")


class Load:
    """One call of ``ingest_files``: what it loads, and where to."""

    def __init__(self, spark, target_table, target_schema, cols, target_path, ledger_path, defaults, now,
                 csv_block_bytes=BLOCK_BYTES):
        self.spark, self.target_table, self.schema, self.cols = spark, target_table, target_schema, cols
        self.types = {f.name: f.dataType for f in target_schema.fields}
        self.target_path, self.ledger_path = target_path.rstrip("/"), ledger_path.rstrip("/")
        self.defaults, self.now, self.csv_block_bytes = defaults, now, csv_block_bytes

    def run(self, path: str, file_type: str, etag_mode: str) -> tuple[int, int, int]:
        """One attempt: (processed, skipped, failed)."""
        seen = manifest.newest(self.spark, self.ledger_path)
        listing = list_files(self.spark, path, file_type, etag_mode).withColumn("target_table", F.lit(self.target_table))
        done = current_ledger(read_ledger(self.spark, self.ledger_path)).where(F.col("status") == SUCCESS)
        keys = ["target_table", "file_key", "etag"]
        # One pass over the listing marks each file done or not.
        marked = listing.join(done.select(*keys, F.lit(True).alias("_done")), keys, "left").checkpoint()
        todo = marked.where(F.col("_done").isNull()).drop("_done")
        counts = marked.agg(F.count_if(F.col("_done").isNull()).alias("todo"),
                            F.count_if(F.col("_done").isNotNull()).alias("skipped")).first()
        if not counts["todo"]:
            return 0, counts["skipped"], 0

        run = manifest.new_run()
        serial = seen.state.get("serials", {}).get(self.target_table, 0)
        processed = failed = 0
        for batch in self._batches(todo, counts["todo"]):
            good, bad, serial = self._load_batch(todo, batch, run, serial)
            processed, failed = processed + good, failed + bad
        self.publish(seen, run, serial, wrote_rows=processed > 0)
        return processed, counts["skipped"], failed

    def _batches(self, todo: DataFrame, n: int):
        """Runs of the sorted (file_key, ext): the driver holds the names of one batch at a time."""
        ordered = todo.select("file_key", "ext").orderBy("file_key")
        batch = []
        for r in ordered.collect() if n <= MAX_FILES_PER_BATCH else ordered.toLocalIterator():
            batch.append((r["file_key"], r["ext"]))
            if len(batch) == MAX_FILES_PER_BATCH:
                yield batch
                batch = []
        if batch:
            yield batch

    def publish(self, seen: manifest.Generation, run: str, serial: int, wrote_rows: bool) -> None:
        """Rows and ledger rows of ``run`` become visible together, or not at all."""
        state = dict(seen.state)
        state["ledger"] = [*state.get("ledger", []), run]
        if wrote_rows:
            mine = _folder(self.spark, self.target_path)
            targets = dict(state.get("targets", {}))
            state["targets"] = targets | {mine: [*targets.get(mine, []), run]}
        state["serials"] = state.get("serials", {}) | {self.target_table: serial}
        manifest.publish(self.spark, self.ledger_path, seen, state)

    def _load_batch(self, todo: DataFrame, batch: list[tuple[str, str]], run: str, serial: int) -> tuple[int, int, int]:
        """Judge and load a batch of files: (good files, bad files, the last serial number)."""
        files = todo.where(F.col("file_key").between(batch[0][0], batch[-1][0]))
        verdicts = self._judge(files, batch)
        good = [(r["file_key"], r["ext"], r["kind"], r["copy"]) for r in verdicts.where("error_message IS NULL")
                .select("file_key", "ext", "kind", "copy").collect()]  # names of one batch
        if good:
            serial = self._write_rows(verdicts.where("error_message IS NULL"), good, run, serial)
        ledger = verdicts.select("target_table", "file_key", "etag", "file_size",
                                 F.when(F.col("error_message").isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
                                 "error_message", ntz_literal(self.now).alias("loaded_at"))
        ledger.write.mode("append").parquet(f"{self.ledger_path}/run={run}")
        return len(good), len(batch) - len(good), serial

    def _judge(self, files: DataFrame, batch: list[tuple[str, str]]) -> DataFrame:
        """The files with ``kind`` (Parquet types), ``copy`` (a visible copy's path) and ``error_message``."""
        # Spark's readers pass over hidden names; such files are copied to plain ones. CSV is not read by them.
        hidden = [k for k, e in batch if e != "csv" and k.rsplit("/", 1)[1][0] in "_."]
        named = files.withColumn("copy", F.lit(None).cast("string"))
        if hidden:
            shown = F.regexp_extract("file_key", "([^/]*)$", 1).rlike("^[_.]") & (F.col("ext") != "csv")
            copies = visible_copies(files.where(shown & (F.col("file_size") > 0)), work_dir(self.spark, "ingest-copies")).checkpoint()
            named = files.join(copies, "file_key", "left")
        empty = (F.col("file_size") == 0) & F.col("ext").isin("json", "parquet")
        named = named.withColumn("error_message", F.when(empty, F.lit("the file is empty")))
        if any(e == "parquet" for _, e in batch):
            footers = _parquet_footers(named.where("ext = 'parquet' AND error_message IS NULL"), self.cols)
            footers = footers.withColumnRenamed("error_message", "_footer_error").checkpoint()
            named = named.join(footers, "file_key", "left").withColumn("error_message", F.coalesce("error_message", "_footer_error")).drop("_footer_error")
        else:
            named = named.withColumns({"kind": F.lit(None).cast("string"), "footer_rows": F.lit(None).cast("long")})
        named = named.checkpoint()
        sound = [(r["file_key"], r["ext"], r["kind"], r["copy"])
                 for r in named.where("error_message IS NULL").select("file_key", "ext", "kind", "copy").collect()]  # names of one batch
        if not sound:
            return named
        rows = self._rows(named.where("error_message IS NULL"), sound)
        # One offending column per file, chosen deterministically; a file is never gathered whole.
        problem = F.coalesce(F.when(F.col("_corrupt"), F.lit("unparsable record")),
                             *[F.when(_bad_value(c, self.types[c]), F.lit(f"invalid value for column {c}")) for c in self.cols])
        found = rows.groupBy("file_key").agg(F.min(problem).alias("_problem"), F.count(F.lit(1)).alias("_rows"))
        short = F.coalesce("_rows", F.lit(0)) < F.col("footer_rows")  # never true of other formats
        judged = named.join(found, "file_key", "left")
        return judged.withColumn("error_message", F.coalesce(
            "error_message", F.when(short, F.lit("unreadable parquet file: pages are damaged")), "_problem")).drop("_problem", "_rows").checkpoint()

    def _rows(self, files: DataFrame, names: list[tuple]) -> DataFrame:
        """All rows of the named files (file_key, ext, Parquet kind, copy), as text columns."""
        groups: dict[tuple, list[str]] = {}
        for key, ext, kind, copy in names:
            groups.setdefault((ext, kind or ""), []).append(copy or key)
        out = None
        for (ext, _), paths in sorted(groups.items()):
            part = _read_text_columns(self.spark, ext, files.where(F.col("ext") == ext), paths, self.cols, self.csv_block_bytes)
            out = part if out is None else out.unionByName(part)
        if any(copy for *_, copy in names):
            back = F.broadcast(files.where("copy IS NOT NULL").select(plain_key(F.col("copy")).alias("copy"), F.col("file_key").alias("_key")))
            out = (out.join(back, F.col("file_key") == F.col("copy"), "left")
                   .withColumn("file_key", F.coalesce("_key", "file_key")).drop("copy", "_key"))
        return out

    def _write_rows(self, files: DataFrame, names: list[tuple], run: str, serial: int) -> int:
        """Append the files' rows to the run's folder; returns the last serial number."""
        values = [F.col(c).cast(self.types[c]).alias(c) for c in self.cols]
        rows = self._rows(files, names)
        serials = [c for c, d in self.defaults.items() if d == SERIAL]
        if serials:
            rows, serial = self._numbered(rows, serial)
        for c, d in self.defaults.items():
            values.append((F.col("_serial") if d == SERIAL else ntz_literal(self.now)).cast(self.types[c]).alias(c))
        rows = rows.select(*values)
        order = [F.col(f.name) for f in self.schema.fields if f.name in rows.columns]
        rows.select(*order).write.mode("append").parquet(f"{self.target_path}/run={run}")
        return serial

    def _numbered(self, rows: DataFrame, after: int) -> tuple[DataFrame, int]:
        """``rows`` with ``_serial``: numbers after ``after``, by file and place in it, and the last of them.

        Rows are written once with their place; the rows of one file in one
        task lie together, so a number per (file, task) fixes all of theirs and
        no row moves. Those numbers are at most as many as the batch's files and splits.
        """
        staged = work_dir(self.spark, "ingest-staged")
        rows.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
        held = self.spark.read.parquet(staged).withColumn("_task", F.shiftright("_at", 33))
        parts = sorted(tuple(r) for r in held.groupBy("file_key", "_task").agg(F.min("_at"), F.count(F.lit(1))).collect())
        starts = []
        for key, task, first, n in parts:
            starts.append((key, task, after + 1 - first))
            after += n
        shift = self.spark.createDataFrame(starts, "file_key string, _task long, _shift long")
        numbered = held.join(F.broadcast(shift), ["file_key", "_task"])
        return numbered.withColumn("_serial", F.col("_at") + F.col("_shift")), after
