"""Numbered manifests: what a folder of immutable sub-folders consists of right now.

A manifest is one small JSON file ``<root>/manifests/<number>.json`` that holds
the whole state. It appears under its name complete or not at all, and a number
is given once: whoever worked from generation ``n`` may publish ``n + 1`` only
if nobody else has. Readers take the newest. Data folders that no manifest names
are left-overs of runs that stopped, and nobody reads them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from contrail.sources import fs

FOLDER = "manifests"
KEEP = 50


class Conflict(RuntimeError):
    """Another writer has published since this one began."""


@dataclass(frozen=True)
class Generation:
    number: int = 0
    state: dict = field(default_factory=dict)


def new_run() -> str:
    return uuid.uuid4().hex


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = fs.list_files(spark, f"{root.rstrip('/')}/{FOLDER}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def newest(spark: SparkSession, root: str) -> Generation:
    """The current generation; number 0 with an empty state where nothing was published."""
    numbers = _numbers(spark, root)
    if not numbers:
        return Generation()
    return Generation(numbers[-1], json.loads(fs.read_text(spark, _path(root, numbers[-1]))))


def publish(spark: SparkSession, root: str, seen: Generation, state: dict) -> Generation:
    """Make ``state`` the generation after ``seen``; Conflict if there is one already."""
    number = seen.number + 1
    if not fs.create_whole(spark, _path(root, number), json.dumps(state)):
        raise Conflict(f"generation {number} of {root} is taken")
    for old in _numbers(spark, root)[:-KEEP]:
        fs.delete(spark, _path(root, old))
    return Generation(number, state)


def _path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{number:020d}.json"
