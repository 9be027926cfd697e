"""Which folders make up a table: versions of its parts, and numbered manifests that name them.

    table/versions/version=<v>/_load_date=<day>/...   files of one write; never changed afterwards
    table/manifests/<number>                          for each load date the versions that hold its rows

A writer puts all it writes into a version folder of its own and then creates the next manifest by renaming a finished
file to its number, which fails when the number is taken. That rename is the only step readers can see, so they find the table
before the write or after it, whatever a crash leaves behind, and of two writers that started from the same manifest
the second fails instead of undoing the first. Parts that a write does not concern are referred to, not copied.
Folders that no kept manifest names go with `sweep`. This asks of the file system that a rename is atomic (as HDFS's is) and
finds its target taken.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession

from .workspace import create_file, delete_path, list_names, read_text

#: Manifests that `sweep` keeps, for readers that still work on an older state.
KEEP = 3


class ConcurrentWrite(RuntimeError):
    """Another writer has changed the table since this one looked at it; nothing was published."""


@dataclass(frozen=True)
class KeyIndex:
    """A bucketed table of keys beside the table: see `sources.keys`."""

    keys: tuple[str, ...]
    buckets: int
    generation: str
    versions: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    """State of a table. A part is a load date, or None for a table without load dates."""

    number: int = 0
    parts: dict[date | None, tuple[str, ...]] = field(default_factory=dict)
    columns: dict[date | None, dict[str, str]] = field(default_factory=dict)  # unknown source columns of each part
    index: KeyIndex | None = None

    def named(self) -> set[str]:
        return {v for versions in self.parts.values() for v in versions}


def new_version() -> str:
    return f"v{uuid.uuid4().hex}"


def version_path(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/versions/version={version}"


def keys_path(path: str, generation: str) -> str:
    return f"{path.rstrip('/')}/keys/{generation}"


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/manifests"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in list_names(spark, _folder(path)) if name.isdigit())


def _day(text: str) -> date | None:
    return date.fromisoformat(text) if text else None


def _load(spark: SparkSession, path: str, number: int) -> Manifest:
    content = json.loads(read_text(spark, f"{_folder(path)}/{number:012d}"))
    index = content["index"]
    return Manifest(
        number,
        {_day(day): tuple(versions) for day, versions in content["parts"].items()},
        {_day(day): columns for day, columns in content["columns"].items()},
        KeyIndex(tuple(index["keys"]), index["buckets"], index["generation"], tuple(index["versions"])) if index else None,
    )


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest; None where there is no table."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def commit(
    spark: SparkSession,
    path: str,
    base: Manifest | None,
    parts: dict[date | None, tuple[str, ...]],
    index: KeyIndex | None = None,
    columns: dict[date | None, dict[str, str]] | None = None,
) -> Manifest:
    """Publish ``parts`` as the whole table, on condition that ``base`` is still its state."""
    made = Manifest((base.number if base else 0) + 1, {d: v for d, v in parts.items() if v}, columns or {}, index)
    text = {
        "parts": {d.isoformat() if d else "": list(v) for d, v in made.parts.items()},
        "columns": {d.isoformat() if d else "": c for d, c in made.columns.items() if d in made.parts},
        "index": index and {"keys": index.keys, "buckets": index.buckets, "generation": index.generation, "versions": index.versions},
    }
    if not create_file(spark, f"{_folder(path)}/{made.number:012d}", json.dumps(text)):
        raise ConcurrentWrite(f"{path} was changed by another writer; run the job again")
    return made


def sweep(spark: SparkSession, path: str, keep: int = KEEP) -> list[str]:
    """Delete what the last ``keep`` manifests do not name: old versions, those of failed writes, old key tables.

    Runs as the table's writer: a write that is under way would lose its unpublished version. Returns what went.
    """
    numbers = _numbers(spark, path)
    kept = [_load(spark, path, n) for n in numbers[-keep:]]
    versions = {f"version={v}" for m in kept for v in m.named()}
    generations = {m.index.generation for m in kept if m.index}
    root, gone = path.rstrip("/"), []
    for folder, used in (("versions", versions), ("keys", generations)):
        gone += [f"{root}/{folder}/{name}" for name in list_names(spark, f"{root}/{folder}") if name not in used]
    gone = [f"{_folder(path)}/{n:012d}" for n in numbers[:-keep]] + gone  # manifests first: none may name what is gone
    for item in gone:
        delete_path(spark, item)
    return gone
