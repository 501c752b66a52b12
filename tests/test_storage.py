"""Changes of a table that end at any step: the table is the old or the new version, and the next job goes on."""

import glob
import os
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from airshed.operators import sinks, storage

STEPS = ["move", "delete", "write_text", "_renew"]


class Killed(BaseException):
    pass


class Mortal:
    """Lets a process live for a number of storage steps; then it is dead, and none of its handlers can do a thing."""

    def __init__(self, monkeypatch, steps):
        self.left, self.real = steps, {n: getattr(storage, n) for n in STEPS}
        for name in STEPS:
            monkeypatch.setattr(storage, name, lambda *a, n=name: self.step(n, *a))

    def step(self, name, *args):
        if self.left <= 0:
            raise Killed()
        self.left -= 1
        return self.real[name](*args)


def days(spark, *rows):
    return spark.createDataFrame(rows, "day int, v int")


def write(df):
    return lambda staging: storage.write_partitioned(df, staging, ["day"])


def put(*rows):
    """Writes rows without a Spark job, as the kill tests write many times."""
    def into(staging):
        for n, (day, v) in enumerate(rows):
            os.makedirs(f"{staging}/day={day}", exist_ok=True)
            pq.write_table(pa.table({"v": pa.array([v], pa.int32())}), f"{staging}/day={day}/{uuid.uuid4().hex}-{n}.parquet")
    return into


def content(spark, path):
    table = storage.read_if_exists(spark, path)
    return None if table is None else sorted((r.day, r.v) for r in table.collect())


def files_of(spark, path):
    """As :func:`content`, from the files that a reader would see."""
    storage.settle(spark, path)
    found = [(int(os.path.dirname(f).rpartition("=")[2]), pq.ParquetFile(f).read()["v"][0].as_py())
             for f in glob.glob(f"{path}/day=*/[!_.]*.parquet")]
    return sorted(found) or None


CHANGES = {
    "replace": (lambda spark, path: storage.replace_table(spark, path, put((1, 10), (4, 40))),
                [(1, 10), (4, 40)]),
    "partitions": (lambda spark, path: storage.replace_partitions(
        spark, path, put((2, 20), (4, 40)), gone=lambda name: name == "day=3"),
        [(1, 1), (2, 20), (4, 40)]),
    "append": (lambda spark, path: storage.append_batch(spark, path, "two", put((1, 10), (5, 50))),
               [(1, 1), (1, 10), (2, 2), (3, 3), (5, 50)]),
    "replay": (lambda spark, path: storage.append_batch(spark, path, "one", put((1, 7), (6, 60))),
               [(1, 7), (6, 60)]),
    "take back": (lambda spark, path: storage.remove_batch(spark, path, "one"), None),
}
OLD = [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("kind", CHANGES)
def test_killed_at_every_step(spark, tmp_dir, monkeypatch, kind):
    change, new = CHANGES[kind]
    may_be = (OLD, new, None) if kind == "replay" else (OLD, new)  # a replay first takes its former files back
    monkeypatch.setattr(storage, "GRACE_SECONDS", 0.0)
    seen, steps = set(), 0
    while True:
        path = f"{tmp_dir}/{steps}/t"
        os.makedirs(os.path.dirname(path))
        storage.append_batch(spark, path, "one", put(*OLD))
        with monkeypatch.context() as patched:
            Mortal(patched, steps)
            try:
                change(spark, path)
                ended = True
            except Killed:
                ended = False
        got = files_of(spark, path)                   # the next reader
        assert got in may_be, (steps, got)
        seen.add(str(got))
        assert storage.names_in(spark, storage._intents(path)) == []
        change(spark, path)                           # the job once more
        assert files_of(spark, path) == new
        if ended:
            assert content(spark, path) == new
            break
        steps += 1
    assert steps >= 3 and len(seen) >= 2


def test_a_failing_move_is_finished_by_the_next_reader(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    storage.replace_table(spark, path, write(days(spark, (1, 1))))
    with monkeypatch.context() as patched:
        def full(*_):
            raise OSError("no space")
        patched.setattr(storage, "move", full)
        with pytest.raises(OSError):
            storage.replace_table(spark, path, write(days(spark, (2, 2))))
    assert content(spark, path) == [(2, 2)]           # no wait: the writer has said that it gave up
    assert sorted(os.listdir(tmp_dir)) == ["t"]


def test_a_reader_waits_for_a_live_writer(spark, tmp_dir, monkeypatch):
    path, intent = f"{tmp_dir}/t", f"{tmp_dir}/_intents-t/0-x.json"
    storage.replace_table(spark, path, write(days(spark, (1, 1))))
    os.makedirs(os.path.dirname(intent), exist_ok=True)
    storage.write_text(spark, intent, '{"records": [], "moves": [], "gone": [], "remove": []}')
    waits = []

    def sleep(seconds):
        waits.append(seconds)
        if len(waits) == 3:
            storage.delete(spark, intent)              # the writer is done
    monkeypatch.setattr(storage.time, "sleep", sleep)
    assert content(spark, path) == [(1, 1)] and len(waits) == 3


def test_a_load_looks_at_its_own_files_only(spark, tmp_dir, monkeypatch):
    """What a load lists doesn't depend on the table: its staging folder and the intents."""
    path, listed = f"{tmp_dir}/t", []
    for k in range(4):
        storage.append_batch(spark, path, f"b{k}", write(days(spark, *[(d, k) for d in range(k * 5, k * 5 + 5)])))
    real = storage.names_in
    monkeypatch.setattr(storage, "names_in", lambda s, p: listed.append(p) or real(s, p))
    storage.append_batch(spark, path, "b2", write(days(spark, (50, 9))))
    assert listed and not [p for p in listed if p.startswith(path)]
    monkeypatch.undo()
    assert [r for r in content(spark, path) if r[1] in (2, 9)] == [(50, 9)]
    assert len(content(spark, path)) == 16


def test_partitions_are_opened_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    frame = spark.createDataFrame([(1, "a b"), (2, "x/y=z"), (3, None), (4, "é%"), (5, "[q]^{1}")], "v int, place string")
    frame.write.partitionBy("place").parquet(path)
    for value, v in (("a b", 1), ("x/y=z", 2), (None, 3), ("é%", 4), ("[q]^{1}", 5)):
        assert [r.v for r in storage.read_partitions(spark, path, "place", [value]).collect()] == [v]
    some = storage.read_partitions(spark, path, "place", ["a b", None, "not there"])
    assert sorted((r.v, r.place) for r in some.collect()) == [(1, "a b"), (3, None)]
    assert storage.read_partitions(spark, path, "place", ["not there"]) is None


def test_a_stray_old_day_opens_two_folders(spark, tmp_dir):
    path, schema = f"{tmp_dir}/t", "k string, day int, seq int"
    for day in range(1, 31):
        storage.append_batch(spark, path, f"d{day}", write(days(spark, (day, day))))
    batch = days(spark, (1, 100), (30, 100))
    values = sinks.partition_values(batch, "day")
    opened = storage.read_partitions(spark, path, "day", values)
    assert len({os.path.dirname(f) for f in opened.inputFiles()}) == 2
    target = storage.read_if_exists(spark, path)
    new = sinks.insert_if_absent(target, batch, ["day"], ["v"], prune_col="day")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and "day#" in plan and "IN (1,30)" in plan
    assert new.count() == 0 and schema


def test_loads_without_a_key(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.append_rows(path, days(spark, (1, 1), (1, 1)), partition_by=["day"])
    name = sinks.append_rows(path, days(spark, (1, 1)), "again", ["day"])
    assert name == "again" and content(spark, path) == [(1, 1)] * 3
    sinks.append_rows(path, days(spark, (1, 1), (2, 2)), "again", ["day"])
    assert content(spark, path) == [(1, 1)] * 3 + [(2, 2)]
    assert storage.load_files(spark, path, "again") and storage.load_files(spark, path, "none") is None


def test_a_strict_load_does_not_collide_with_itself(spark, tmp_dir):
    path, rows = f"{tmp_dir}/t", days(spark, (1, 1), (2, 2))

    def load(name, batch):
        target = sinks.read_without(spark, path, name)
        sinks.strict_append(path, batch.limit(0) if target is None else target, batch, ["day"], partition_by=["day"],
                            load=name)
    load("a", rows)
    load("a", rows)
    with pytest.raises(ValueError, match="2 conflicting keys"):
        load("b", rows)
    assert content(spark, path) == [(1, 1), (2, 2)]


def test_other_threads_keep_their_sleep(monkeypatch):
    monkeypatch.setattr(storage.time, "sleep", None)
    assert callable(time.sleep) and storage.time.time() <= time.time()
