"""Bronze snapshots -> flight mart rows (one row per aircraft state vector).

A snapshot payload is ``{"time": n, "states": [[...17 values...], ...]}``.
The payload is parsed once with a pruned schema (``states`` as
``array<array<string>>``: scalars come back as text, the nested array at
position 12 as raw JSON, JSON null as NULL), exploded, and each position is
cast to its mart column. Everything is narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contrail import schemas
from contrail.functions import casts
from contrail.functions.memo import memo
from contrail.functions.time import micros_to_ntz, seconds_to_ntz

# 0-based position of each mart column inside a state vector.
# Position 12 (a nested sensor list) is not part of the mart.
STATE_POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "true_track": 10,
    "vertical_rate": 11,
    "geo_altitude": 13,
    "squawk": 14,
    "spi": 15,
    "position_source": 16,
}

# Names of the two constant change-data-capture marker columns.
CDC_MARKERS = ("_peerdb_is_deleted", "_peerdb_version")

_TEXT = ("icao24", "callsign", "origin_country", "squawk")
_DOUBLE = ("longitude", "latitude", "baro_altitude", "velocity", "true_track",
           "vertical_rate", "geo_altitude")
_BOOL = ("on_ground", "spi")
_TIME = ("time_position", "last_contact")


def parse_payload(data: Column) -> Column:
    """One JSON parse per snapshot with only the fields we read."""
    return F.from_json(data, schemas.PAYLOAD)


def parse_states(data: Column) -> Column:
    """``states`` as ``array<array<string>>``, robust to malformed elements.

    The fast path is one typed parse. If any element is not an array (a
    stray string or object), that parse yields NULL for the whole list; only
    then does the fallback split ``states`` into raw element texts and parse
    each on its own, so the bad element becomes NULL (a row of NULLs after
    the explode) instead of losing the whole snapshot. ``coalesce`` only
    evaluates the fallback when the fast parse failed.
    """
    fast = parse_payload(data).getField("states")
    raw = F.from_json(data, "states array<string>").getField("states")
    slow = F.transform(raw, lambda e: F.from_json(F.concat(F.lit('{"r":'), e, F.lit("}")),
                                                  "r array<string>").getField("r"))
    return F.coalesce(fast, slow)


def state_count(data: Column) -> Column:
    """Number of state vectors in a payload; 0 for null/empty/missing/bad."""
    return F.coalesce(F.size(parse_states(data)), F.lit(0))


def _lenient(name: str, raw: Column, bool_mode: str, time_mode: str) -> Column:
    if name in _TEXT:
        return raw
    if name in _DOUBLE:
        return casts.f64_or_null(raw)
    if name in _BOOL:
        return casts.to_bool(raw, bool_mode)
    if name in _TIME:
        if time_mode == "null":
            secs = casts.u32_or_null(raw)  # unparsable text -> NULL, not 1970
        elif time_mode == "or_zero":
            secs = casts.u32_or_zero(raw)
        else:
            raise ValueError(f"unknown time mode {time_mode!r}")
        return seconds_to_ntz(secs)
    if name == "position_source":
        return casts.i32_or_null(raw)
    raise KeyError(name)


def _strict(name: str, raw: Column) -> Column:
    if name in _TEXT:
        return raw
    if name in _DOUBLE:
        return casts.strict_double(raw)
    if name in _BOOL:
        return casts.strict_bool(raw)
    if name in _TIME:
        # Fractional unix seconds are allowed; a bad value fails the query.
        micros = F.round(casts.strict_double(raw) * F.lit(1_000_000.0)).cast("bigint")
        return micros_to_ntz(micros)
    if name == "position_source":
        return casts.strict_int(raw)
    raise KeyError(name)


def flatten(bronze: DataFrame, mode: str = "lenient", bool_mode: str = "cast",
            time_mode: str = "null", id_name: str = "load_id",
            cdc_markers: bool = False) -> DataFrame:
    """Flatten bronze ``(load_id, ingest_time, data)`` into mart rows.

    mode ``lenient`` turns bad values into NULL (numbers, times) or 0;
    mode ``strict`` uses ANSI casts so a bad value raises.
    ``id_name`` / ``cdc_markers`` produce the change-data-capture variant
    (``id`` plus two constant marker columns).
    """
    if mode not in ("lenient", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    key = ("flatten", mode, bool_mode, time_mode, id_name, cdc_markers)
    explode_cols, cols = memo(key, lambda: _projection(mode, bool_mode, time_mode, id_name, cdc_markers))
    return bronze.select(*explode_cols).select(*cols)


def _projection(mode, bool_mode, time_mode, id_name, cdc_markers):
    explode_cols = [
        F.col("load_id").cast("bigint").alias(id_name),
        F.col("ingest_time").alias("uploaded_at"),
        F.explode(parse_states(F.col("data"))).alias("_r"),
    ]
    cols = [F.col(id_name), F.col("uploaded_at")]
    for name in schemas.MART_COLUMNS[2:]:
        raw = F.get(F.col("_r"), STATE_POSITIONS[name])
        expr = _lenient(name, raw, bool_mode, time_mode) if mode == "lenient" else _strict(name, raw)
        cols.append(expr.alias(name))
    if cdc_markers:
        cols.append(F.lit(0).cast("smallint").alias(CDC_MARKERS[0]))
        cols.append(F.lit(0).cast("bigint").alias(CDC_MARKERS[1]))
    return explode_cols, cols


def rename_id(mart: DataFrame, old: str = "id", new: str = "load_id") -> DataFrame:
    """Schema evolution ``RENAME COLUMN id TO load_id``, applied at read time."""
    return mart.withColumnRenamed(old, new)
