"""Tables as folders of files, changed so that a job that ends at any moment leaves a whole version.

A change (a new version, new partitions, more files) is written whole to a folder beside the table. Then an intent, a
small file that lists the moves still to do, is put beside the table in one step: that decides the change. Before it the
table is as it was; after it whoever meets the intent finishes the moves, be it the writer, the next reader or the next
writer, and each move can be repeated. So a table or partition is the old or the new version, never absent.

A live writer renews its intent with every move. Others wait for it, and finish the change once there has been no sign
of life for ``GRACE_SECONDS``. Files that are added carry the name of their load, and a record in the table lists them,
so a load is taken back and written again as a whole without a look at the rest of the table. Only names of folders and
of a load's files pass through the driver.
"""

from __future__ import annotations

import json
import re
import time as _clock
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from types import SimpleNamespace
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# This module's own clock: whoever puts another sleep here leaves that of the other threads as it is.
time = SimpleNamespace(time=_clock.time, time_ns=_clock.time_ns, sleep=_clock.sleep)
GRACE_SECONDS = 60.0
# Fixed value: the folder name that stands for a partition value of NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: the characters that Spark's writer escapes in a partition's folder name.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
_RECORDS = "_loads"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files and folders in a folder (hidden ones are left out); none if it doesn't exist."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(jpath)]
    return sorted(n for n in names if n[0] not in "._")


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, jsource = _fs(spark, source)
    _, jtarget = _fs(spark, target)
    fs.mkdirs(jtarget.getParent())
    if fs.exists(jtarget) or not fs.rename(jsource, jtarget):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, jpath = _fs(spark, path)
    _, half = _fs(spark, f"{jpath.getParent()}/_{uuid.uuid4().hex}.part")
    out = fs.create(half)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(half, jpath):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# ---------------------------------------------------------------------------------------------------------------------
# Intents

def _beside(path: str) -> tuple[str, str]:
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder, name


def _intents(path: str) -> str:
    folder, name = _beside(path)
    return f"{folder}/_intents-{name}"


def _renew(spark: SparkSession, intent: str, at: float | None = None) -> None:
    fs, jpath = _fs(spark, intent)
    fs.setTimes(jpath, int((time.time() if at is None else at) * 1000), -1)


def _delete_if_empty(spark: SparkSession, folder: str) -> None:
    fs, jpath = _fs(spark, folder)
    if fs.exists(jpath) and not fs.listStatus(jpath):
        try:
            fs.delete(jpath, False)
        except Py4JJavaError:  # a writer has just put a file there
            if not fs.listStatus(jpath):
                raise


def _put(spark: SparkSession, source: str, target: str, aside: str | None) -> None:
    """Put ``source`` in the place of ``target``, whose former content goes ``aside``; done already if there is no
    source. Without ``aside`` there was nothing at the target."""
    if path_exists(spark, source):
        if aside and path_exists(spark, target) and not path_exists(spark, aside):
            move(spark, target, aside)
        move(spark, source, target)


def _finish(spark: SparkSession, intent: str) -> None:
    """Do what an intent lists and remove it; every step may have been done before."""
    text = read_text(spark, intent)
    if text is None:
        return
    steps = json.loads(text)
    for target, content in steps["records"]:
        if not path_exists(spark, target):
            write_text(spark, target, content)
    for source, target, aside in steps["moves"]:
        _put(spark, source, target, aside)
        _renew(spark, intent)
    for target, aside in steps["gone"]:
        if path_exists(spark, target) and not path_exists(spark, aside):
            move(spark, target, aside)
    for path in steps["remove"]:
        delete(spark, path)
    for folder in steps["tidy"]:
        _delete_if_empty(spark, folder)
    delete(spark, intent)
    _delete_if_empty(spark, _beside(intent)[0])


def _decide(spark: SparkSession, path: str, moves: Sequence[tuple[str, str, str | None]],
            gone: Sequence[tuple[str, str]] = (), remove: Sequence[str] = (),
            records: Sequence[tuple[str, str]] = (), tidy: Sequence[str] = ()) -> None:
    """Write the intent of a change, which decides it, and finish it: records are written, sources moved to their
    targets, what is gone put aside, paths removed, and folders that are empty then removed too. A failure leaves the
    intent, free for the next reader or writer."""
    folder = _intents(path)
    fs, jfolder = _fs(spark, folder)
    fs.mkdirs(jfolder)
    intent = f"{folder}/{time.time_ns():020d}-{uuid.uuid4().hex}.json"
    write_text(spark, intent, json.dumps({"records": list(records), "moves": list(moves), "gone": list(gone),
                                          "remove": list(remove), "tidy": list(tidy)}))
    try:
        _finish(spark, intent)
    except BaseException:
        if path_exists(spark, intent):
            _renew(spark, intent, 0)
        raise


def settle(spark: SparkSession, path: str) -> None:
    """Finish the changes of a table that are decided and that no live writer is at."""
    folder = _intents(path)
    for name in names_in(spark, folder):
        intent = f"{folder}/{name}"
        fs, jpath = _fs(spark, intent)
        while fs.exists(jpath):
            if time.time() - fs.getFileStatus(jpath).getModificationTime() / 1000 >= GRACE_SECONDS:
                _finish(spark, intent)
                break
            time.sleep(min(1.0, GRACE_SECONDS))


# ---------------------------------------------------------------------------------------------------------------------
# Reading

def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``; None only where there is no data file at all. Every other failure is raised."""
    settle(spark, path)
    return spark.read.format(fmt).load(path) if names_in(spark, path) else None


def partition_folder(column: str, value: object) -> str:
    """The folder of a partition value, as Spark's writer names it (a date, number or text; None is NULL)."""
    if value is None:
        return f"{column}={NULL_PARTITION}"
    text = value.isoformat() if isinstance(value, date) else str(value)
    return f"{column}=" + _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text)


def read_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object],
                    fmt: str = "parquet") -> DataFrame | None:
    """The partitions of a table that hold these values, None where there is none of them.

    Only their folders are looked at: a table of many years costs no more to open than one of few days.
    """
    settle(spark, path)
    folders = [f"{path.rstrip('/')}/{partition_folder(column, v)}" for v in values]
    found = [f for f in folders if path_exists(spark, f)]
    return spark.read.format(fmt).option("basePath", path).load(found) if found else None


# ---------------------------------------------------------------------------------------------------------------------
# Writing

def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                      fmt: str = "parquet", mode: str = "append", ranges: bool = False) -> None:
    """Write a table with few files per partition, the rows of each file in order of ``sort_within``.

    Rows are dealt by partition value first (adaptive execution splits a large value over several tasks and joins small
    ones), then sorted by partition and lookup columns: the writer needs the first and so keeps the second. With
    ``ranges`` rows are dealt by ranges of all these columns, so the files of a large value have narrow key ranges and a
    lookup skips most of them; the input is looked at once more to find the ranges, so it should be a written table.
    """
    order = [*partition_by, *[c for c in sort_within if c not in partition_by]]
    if ranges and order:
        out = df.repartitionByRange(*order)
    else:
        out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    if sort_within:
        out = out.sortWithinPartitions(*order)
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


@contextmanager
def staged_beside(spark: SparkSession, path: str, write: Callable[[str], None]) -> Iterator[str]:
    """A folder beside ``path`` that ``write`` has filled. It stays where an intent may name it; a failing write's goes."""
    folder, name = _beside(path)
    staging = f"{folder}/_staging-{name}-{uuid.uuid4().hex}"
    try:
        write(staging)
    except BaseException:
        delete(spark, staging)
        raise
    yield staging


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a new version of a table beside it and put it in the table's place."""
    path = path.rstrip("/")
    with staged_beside(spark, path, write) as staging:
        settle(spark, path)
        folder, name = _beside(path)
        old = f"{folder}/_old-{name}-{uuid.uuid4().hex}"
        _decide(spark, path, [(staging, path, old if path_exists(spark, path) else None)], remove=[old])


def replace_partitions(spark: SparkSession, path: str, write: Callable[[str], None],
                       gone: Callable[[str], bool] = lambda name: False) -> None:
    """Write partitions beside a table and put each in the place of its namesake.

    Partitions of the table that the new ones lack are removed where ``gone`` says so (it gets the folder's name, such
    as ``day=2024-01-01``), the others stay.
    """
    path = path.rstrip("/")
    with staged_beside(spark, path, write) as staging:
        settle(spark, path)
        new = [n for n in names_in(spark, staging) if "=" in n]
        present = set(names_in(spark, path))
        old = f"{path}/_old-{uuid.uuid4().hex}"
        _decide(spark, path,
                [(f"{staging}/{n}", f"{path}/{n}", f"{old}/{n}" if n in present else None) for n in new],
                gone=[(f"{path}/{n}", f"{old}/{n}") for n in _vanished(present, new, gone)], remove=[old, staging])


def _vanished(present: Iterable[str], new: Iterable[str], gone: Callable[[str], bool]) -> list[str]:
    return sorted(n for n in set(present) - set(new) if "=" in n and gone(n))


# ---------------------------------------------------------------------------------------------------------------------
# Loads: files that were added together

def _record(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/{_RECORDS}/{quote(batch, safe='')}.json"


def load_files(spark: SparkSession, path: str, batch: str) -> list[str] | None:
    """The files that a load added, relative to the table; None if the table has no such load."""
    text = read_text(spark, _record(path, batch))
    return None if text is None else json.loads(text)


def append_batch(spark: SparkSession, path: str, batch: str, write: Callable[[str], None]) -> None:
    """Add the files of one load to a table, all or none; the load written again replaces its former files."""
    path = path.rstrip("/")
    remove_batch(spark, path, batch)
    with staged_beside(spark, path, write) as staging:
        files = list(_data_files(spark, staging))
        named = ["/".join(p for p in (folder, f"{quote(batch, safe='')}-{name}") if p) for folder, name in files]
        sources = ["/".join(p for p in (staging, folder, name) if p) for folder, name in files]
        _decide(spark, path, [(s, f"{path}/{t}", None) for s, t in zip(sources, named)], remove=[staging],
                records=[(_record(path, batch), json.dumps(named))])


def remove_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Remove exactly the files that a load added, all or none; whether there were any. Looks at the load's record
    only, not at the table."""
    settle(spark, path)
    files = load_files(spark, path, batch)
    if files is not None:
        paths = [f"{path.rstrip('/')}/{name}" for name in files]
        _decide(spark, path, [], remove=[*paths, _record(path, batch)],
                tidy=sorted({_beside(p)[0] for p in paths} - {path.rstrip("/")}))
    return bool(files)


def _data_files(spark: SparkSession, path: str, folder: str = "") -> Iterator[tuple[str, str]]:
    """``(partition folder, file name)`` of a folder's files."""
    for name in names_in(spark, f"{path}/{folder}" if folder else path):
        if "=" in name and "." not in name:
            yield from _data_files(spark, path, f"{folder}/{name}" if folder else name)
        else:
            yield folder, name
