"""Refreshes that readers never see half done, and appends that two runs, a killed run or a repeated run do once."""

import threading

import pytest
from pyspark.sql import functions as F

from martline.plans import jobs
from martline.sources import sinks
from martline.sources.store import Commit, Ledger, Versions

COLS = ["k", "v"]


class Killed(Exception):
    pass


def rows(spark, values):
    return spark.createDataFrame(values, "k int, v string")


def refresh(spark, target, v, n=50, grace=0.0):
    df = spark.range(n).select(F.col("id").cast("int").alias("k"), F.lit(v).alias("v"))
    sinks.full_refresh(df, target, COLS, "2024-01-01", grace_seconds=grace)


def load(spark, target, values, run_id=None, ts="2024-01-01"):
    return jobs._incremental(spark, rows(spark, values), target, ["k"], COLS, ts, False, run_id=run_id)


def stored(spark, target):
    return sorted((r.k, r.v) for r in jobs.read_target(spark, target).collect())


def test_a_reader_that_loops_during_refreshes_never_fails(spark, tmp_dir):
    target = f"{tmp_dir}/dim"
    refresh(spark, target, "0")
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append((len(got := sinks.read_current(spark, target).collect()), len({r.v for r in got})))
            except Exception as e:  # noqa: BLE001 - any failure of the reader fails the test
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(10):
        refresh(spark, target, str(i + 1), grace=3600)
    stop.set()
    reader.join()
    assert not errors and seen and set(seen) == {(50, 1)}
    assert {r.v for r in sinks.read_current(spark, target).collect()} == {"10"}
    refresh(spark, target, "11")
    assert len(Versions(spark, target).published()) == 2  # the current one and the one before


@pytest.mark.parametrize("step", ["place", "publish", "clean", "delete"])
def test_a_refresh_killed_between_any_two_steps(spark, tmp_dir, monkeypatch, step):
    target = f"{tmp_dir}/dim"
    for v in ("a", "b", "c"):
        refresh(spark, target, v)
    from martline.sources import store

    calls = []

    def kill(*args, **_):
        calls.append(args)
        if step == "delete" and len(calls) < 2:
            return original(*args)  # data of an old version goes, then the run dies before its marker does
        raise Killed

    owner = store.Folder if step == "delete" else store.Versions
    original = getattr(owner, step)
    with monkeypatch.context() as m:
        m.setattr(owner, step, kill)
        with pytest.raises(Killed):
            refresh(spark, target, "d")
    assert {r.v for r in sinks.read_current(spark, target).collect()} == ({"c"} if step in ("place", "publish") else {"d"})
    for v in ("e", "f", "g"):
        refresh(spark, target, v)
    assert {r.v for r in sinks.read_current(spark, target).collect()} == {"g"}
    folder = Versions(spark, target).folder
    assert len([n for n in folder.names() if n.startswith("data-")]) == 2 == len(folder.names("_current"))


def test_a_plain_folder_becomes_versioned(spark, tmp_dir):
    target = f"{tmp_dir}/dim"
    rows(spark, [(1, "old")]).write.parquet(target)
    assert stored(spark, target) == [(1, "old")]
    refresh(spark, target, "a", 1)
    assert stored(spark, target) == [(0, "a")]
    refresh(spark, target, "b", 1)
    assert stored(spark, target) == [(0, "b")]
    assert not [n for n in Versions(spark, target).folder.names() if n.startswith("part-")]


def test_table_refresh_keeps_one_old_version(spark):
    spark.sql("drop table if exists versioned_dim")
    places = []
    for v in "abcd":
        sinks.full_refresh(rows(spark, [(1, v)]), "versioned_dim", COLS, "2024-01-01", is_table=True)
        places.append({r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED versioned_dim").collect()}["Location"])
    assert [r.v for r in spark.table("versioned_dim").collect()] == ["d"]
    exists = [Versions(spark, p).folder.exists() for p in places]
    assert exists == [False, False, True, True]
    spark.sql("drop table versioned_dim")


@pytest.fixture
def interleaved(spark, monkeypatch):
    """The other load runs between this load's comparison and its commit."""
    def arrange(other):
        claim, done = Ledger.claim, []

        def claim_after_other(self, commit):
            if not done:
                done.append(True)
                other()
            return claim(self, commit)

        monkeypatch.setattr(Ledger, "claim", claim_after_other)

    return arrange


def test_two_loads_at_once_append_each_row_once(spark, tmp_dir, interleaved):
    target = f"{tmp_dir}/mart"
    assert load(spark, target, [(1, "a")]) == 1
    counts = []
    interleaved(lambda: counts.append(load(spark, target, [(1, "b"), (2, "x")], ts="2024-01-02")))
    counts.append(load(spark, target, [(1, "b"), (2, "x"), (3, "y")], ts="2024-01-03"))
    assert counts == [2, 1]
    assert stored(spark, target) == [(1, "a"), (1, "b"), (2, "x"), (3, "y")]
    assert [c.rows for c in Ledger(spark, target).commits()] == [1, 2, 1]


def test_first_loads_at_once(spark, tmp_dir, interleaved):
    target = f"{tmp_dir}/mart"
    counts = []
    interleaved(lambda: counts.append(load(spark, target, [(1, "a")])))
    counts.append(load(spark, target, [(1, "a"), (2, "b")], ts="2024-01-02"))
    assert counts == [1, 1] and stored(spark, target) == [(1, "a"), (2, "b")]


def test_a_repeated_run_appends_nothing(spark, tmp_dir):
    target = f"{tmp_dir}/mart"
    assert load(spark, target, [(1, "a")], "run-1") == 1
    assert load(spark, target, [(1, "changed")], "run-1") == 0
    assert stored(spark, target) == [(1, "a")]
    assert load(spark, target, [(1, "changed")], "run-2", "2024-01-02") == 1


@pytest.mark.parametrize("step", ["claim", "publish", "drop"])
def test_a_killed_load_is_finished_or_repeated_once(spark, tmp_dir, monkeypatch, step):
    target = f"{tmp_dir}/mart"
    load(spark, target, [(1, "a")])
    original, calls = getattr(Ledger, step), []

    def kill(self, *args):
        calls.append(args)
        if step == "drop" and len(calls) == 1:  # the first drop clears what a killed attempt left
            return original(self, *args)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Ledger, step, kill)
        with pytest.raises(Killed):
            load(spark, target, [(1, "b"), (2, "c")], "night", "2024-01-02")
    assert load(spark, target, [(1, "b"), (2, "c")], "night", "2024-01-02") == (2 if step == "claim" else 0)
    assert stored(spark, target) == [(1, "a"), (1, "b"), (2, "c")]
    assert load(spark, target, [(1, "b"), (2, "c")], "morning", "2024-01-03") == 0


def test_a_version_is_claimed_once(spark, tmp_dir):
    ledger, won = Ledger(spark, f"{tmp_dir}/mart"), []
    threads = [threading.Thread(target=lambda i=i: won.append(ledger.claim(Commit(1, f"r{i}", 0)))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]
    assert len(ledger.commits()) == 1


def test_a_repeated_report_run_appends_once(spark, tmp_dir):
    path = f"{tmp_dir}/report"
    for run in ("monday", "monday", "tuesday", None, None):
        sinks.append_report(rows(spark, [(1, "a"), (2, "b")]), path, run_id=run)
    assert spark.read.option("header", True).csv(path).count() == 8


@pytest.mark.parametrize("step", ["claim", "publish", "drop"])
def test_a_killed_report_run_is_finished_once(spark, tmp_dir, monkeypatch, step):
    path, report = f"{tmp_dir}/report", rows(spark, [(1, "a")])
    original, calls = getattr(Ledger, step), []

    def kill(self, *args):
        calls.append(args)
        if step == "drop" and len(calls) == 1:
            return original(self, *args)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Ledger, step, kill)
        with pytest.raises(Killed):
            sinks.append_report(report, path, run_id="r")
    for run in ("r", "r"):
        sinks.append_report(report, path, run_id=run)
    assert spark.read.option("header", True).csv(path).count() == 1
