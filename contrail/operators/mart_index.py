"""The mart's folders and what is in them: zone map, pruned reads, compaction.

Every write makes folders of its own, ``upload_date=<date>/writer=<name>``, that
never change. When they are whole, a manifest under ``<mart>/_index`` names them
together with a zone each: rows and the least and greatest ``load_id``,
``uploaded_at`` and ``time_position``. Readers open the folders it names, those
of them whose zone can hold what they look for, so a folder that a stopped write
left behind is never read, and planning needs no listing.

Writers add to the index by trying again whenever another was faster. Compaction
merges the folders of one date, origin and tier, once there are ``fan`` of them,
into one of the next tier; the manifest that names the new folder drops the old
ones, so readers see either. The old folders stay for ``grace`` so that streams
and plans at work can finish, and go in a later compaction.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from contrail import schemas
from contrail.sources import fs, manifest

MART_STORED = T.StructType(schemas.MART.fields + [
    T.StructField("upload_date", T.DateType(), True), T.StructField("writer", T.StringType(), True)])
BATCH = "batch"
MERGED = "-merged-"
FAN = 8
TRIES = 20


@dataclass(frozen=True)
class Zone:
    """A folder and the ends of what its rows hold (times as ISO text; None where all are null)."""

    upload_date: str
    writer: str
    rows: int
    load_id: tuple[int, int] | None
    uploaded_at: tuple[str, str] | None
    time_position: tuple[str, str] | None

    @property
    def name(self) -> str:
        return f"upload_date={self.upload_date}/writer={self.writer}"

    @property
    def tier(self) -> int:
        return int(self.writer.split(MERGED)[1].split("-")[0]) if MERGED in self.writer else 0

    @property
    def origin(self) -> str:
        return BATCH if self.writer.startswith(BATCH) else "stream"


def _ends(zones: list[Zone], column: str):
    both = [getattr(z, column) for z in zones if getattr(z, column) is not None]
    return (min(b[0] for b in both), max(b[1] for b in both)) if both else None


def _zone(value: dict) -> Zone:
    pair = lambda v: tuple(v) if v is not None else None
    return Zone(value["upload_date"], value["writer"], value["rows"], pair(value["load_id"]), pair(value["uploaded_at"]), pair(value["time_position"]))


def _index(root: str) -> str:
    return f"{root.rstrip('/')}/_index"


def zones(spark: SparkSession, root: str) -> list[Zone]:
    """The mart's folders; none where nothing was written."""
    return [_zone(z) for z in manifest.newest(spark, _index(root)).state.get("zones", [])]


def new_writer(origin: str = BATCH) -> str:
    return f"{origin}-{uuid.uuid4().hex[:12]}"


def register(spark: SparkSession, root: str, writer: str) -> list[Zone]:
    """Add the folders that ``writer`` has written to the index, in place of earlier ones of that name."""
    pattern = f"{root.rstrip('/')}/upload_date=*/writer={writer}"
    paths = fs.glob(spark, pattern)
    found: list[Zone] = []
    if paths:
        written = spark.read.schema(MART_STORED).option("basePath", root).parquet(*paths)
        ends = [f(c).alias(f"{n}_{c}") for c in ("load_id", "uploaded_at", "time_position") for n, f in (("lo", F.min), ("hi", F.max))]
        for r in written.groupBy("upload_date").agg(F.count(F.lit(1)).alias("rows"), *ends).collect():  # a row per date of one write
            times = [(r[f"lo_{c}"].isoformat(sep=" "), r[f"hi_{c}"].isoformat(sep=" ")) if r[f"lo_{c}"] is not None else None
                     for c in ("uploaded_at", "time_position")]
            ids = (r["lo_load_id"], r["hi_load_id"]) if r["lo_load_id"] is not None else None
            found.append(Zone(r["upload_date"].isoformat(), writer, r["rows"], ids, *times))

    def change(state: dict) -> dict:
        kept = [z for z in state.get("zones", []) if z["writer"] != writer]
        return state | {"zones": [*kept, *map(asdict, found)]}
    _update(spark, root, change)
    return found


def _update(spark: SparkSession, root: str, change: Callable[[dict], dict]) -> None:
    for last in range(TRIES):
        seen = manifest.newest(spark, _index(root))
        try:
            manifest.publish(spark, _index(root), seen, change(seen.state))
            return
        except manifest.Conflict:
            if last == TRIES - 1:
                raise


def read(spark: SparkSession, root: str, chosen: Iterable[Zone]) -> DataFrame:
    """Rows of the chosen folders, with the partition columns; a date filter shows in the plan."""
    chosen = list(chosen)
    if not chosen:
        return spark.createDataFrame([], MART_STORED)
    paths = [f"{root.rstrip('/')}/{z.name}" for z in chosen]
    df = spark.read.schema(MART_STORED).option("basePath", root).parquet(*paths)
    days = sorted({z.upload_date for z in chosen})
    return df.where(F.col("upload_date").isin([date.fromisoformat(d) for d in days]))


def with_top_load(found: list[Zone]) -> list[Zone]:
    """The folders that hold the greatest ``load_id``."""
    top = max((z.load_id[1] for z in found if z.load_id), default=None)
    return [z for z in found if z.load_id and z.load_id[1] == top]


def with_latest(found: list[Zone], until: datetime | None = None) -> list[Zone]:
    """The folders that can hold rows of the latest upload (up to ``until``)."""
    found = [z for z in found if z.uploaded_at]
    if until is not None:
        limit = until.isoformat(sep=" ")
        found = [z for z in found if z.uploaded_at[0] <= limit]
        # An end of a zone is an upload that took place: the latest one is no earlier than the last of them.
        known = max((z.uploaded_at[1] if z.uploaded_at[1] <= limit else z.uploaded_at[0] for z in found), default="")
    else:
        known = max((z.uploaded_at[1] for z in found), default="")
    return [z for z in found if z.uploaded_at[1] >= known]


def with_positions(found: list[Zone], start: datetime, end: datetime) -> list[Zone]:
    """The folders that can hold reports with ``start <= time_position < end``."""
    lo, hi = start.isoformat(sep=" "), end.isoformat(sep=" ")
    return [z for z in found if z.time_position and z.time_position[0] < hi and z.time_position[1] >= lo]


def with_loads(found: list[Zone], lo: int, hi: int) -> list[Zone]:
    """The folders that can hold a ``load_id`` from ``lo`` to ``hi``."""
    return [z for z in found if z.load_id and z.load_id[0] <= hi and z.load_id[1] >= lo]


def compact(spark: SparkSession, root: str, fan: int = FAN, grace: timedelta = timedelta(days=1),
            now: datetime | None = None) -> int:
    """Merge folders where ``fan`` of a date, origin and tier have gathered; returns the number merged away."""
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    _sweep(spark, root, (now - grace).isoformat(sep=" "))
    groups: dict[tuple, list[Zone]] = {}
    for z in zones(spark, root):
        groups.setdefault((z.upload_date, z.origin, z.tier), []).append(z)
    merges = {}
    for (day, origin, tier), members in groups.items():
        if len(members) >= fan:
            merges[f"{origin}{MERGED}{tier + 1}-{uuid.uuid4().hex[:12]}"] = members
    if not merges:
        return 0
    # One job for all merges; the table of names is as long as the folders are many.
    names = spark.createDataFrame([(date.fromisoformat(z.upload_date), z.writer, name) for name, members in merges.items() for z in members],
                                  "upload_date date, writer string, _to string")
    old = [z for members in merges.values() for z in members]
    rows = read(spark, root, old).join(F.broadcast(names), ["upload_date", "writer"])
    (rows.withColumn("writer", F.col("_to")).drop("_to").hint("rebalance", "upload_date", "writer").sortWithinPartitions("uploaded_at")
     .select(*schemas.MART_COLUMNS, "upload_date", "writer").write.mode("append").partitionBy("upload_date", "writer").parquet(root))
    new = [Zone(members[0].upload_date, name, sum(z.rows for z in members),
                *[_ends(members, c) for c in ("load_id", "uploaded_at", "time_position")]) for name, members in merges.items()]
    written = spark.read.schema(MART_STORED).option("basePath", root).parquet(*[f"{root.rstrip('/')}/{z.name}" for z in new if z.rows])
    if written.count() != sum(z.rows for z in new):
        raise RuntimeError("merged folders do not hold the rows of the old ones")
    gone = {z.name for z in old}

    def change(state: dict) -> dict:
        there = [_zone(z) for z in state.get("zones", [])]
        if not gone <= {z.name for z in there}:
            raise manifest.Conflict("another compaction has merged these folders")
        spare = [*state.get("spare", []), *[[name, now.isoformat(sep=" ")] for name in sorted(gone)]]
        return state | {"zones": [asdict(z) for z in there if z.name not in gone] + [asdict(z) for z in new], "spare": spare}
    _update(spark, root, change)
    return len(gone)


def _sweep(spark: SparkSession, root: str, before: str) -> None:
    """Delete folders merged away before a time, then forget them."""
    spare = manifest.newest(spark, _index(root)).state.get("spare", [])
    old = {name for name, when in spare if when <= before}
    for name in old:
        fs.delete(spark, f"{root.rstrip('/')}/{name}")
    if old:
        _update(spark, root, lambda state: state | {"spare": [s for s in state.get("spare", []) if s[0] not in old]})
