"""What loads have touched since the views were refreshed: the days of each table, as small notes beside the tables.

A load notes its days before it changes the table, so a load that ends half-way is noted too; a refresh reads the notes,
recomputes these days and removes the notes it has read. A note for days that did not change in the end costs a
recomputation, never a stale view.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession

from airshed.operators import storage


@dataclass
class Changes:
    """The days of a table that changed (None among them: rows without a day), or that all of it did."""
    days: set[date | None] = field(default_factory=set)
    whole: bool = False
    notes: list[str] = field(default_factory=list)


def _folder(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_changes/{table}"


def note(spark: SparkSession, root: str, table: str, days: Iterable[date | None] | None) -> None:
    """Note that a load touches these days of a table; None stands for the whole table."""
    listed = None if days is None else [d.isoformat() if d else None for d in days]
    if listed != []:
        folder = _folder(root, table)
        fs, jfolder = storage._fs(spark, folder)
        fs.mkdirs(jfolder)
        storage.write_text(spark, f"{folder}/{uuid.uuid4().hex}.json", json.dumps(listed))


def pending(spark: SparkSession, root: str, table: str) -> Changes:
    found = Changes()
    for name in storage.names_in(spark, _folder(root, table)):
        path = f"{_folder(root, table)}/{name}"
        text = storage.read_text(spark, path)
        if text is None:  # another refresh has just read it
            continue
        days = json.loads(text)
        found.notes.append(path)
        found.whole |= days is None
        found.days |= {date.fromisoformat(d) if d else None for d in days or ()}
    return found


def forget(spark: SparkSession, changes: Iterable[Changes]) -> None:
    for change in changes:
        for path in change.notes:
            storage.delete(spark, path)
