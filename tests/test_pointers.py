"""Numbered pointer commits."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from twinloom.plans.layout import RunLayout
from twinloom.session import shared_folder
from twinloom.sinks import artifacts
from twinloom.sinks.folders import create_file, names

DAY = datetime(2025, 1, 1)


def base(spark):
    return shared_folder(spark, "pointers")


def state(spark, layout):
    return {r.table_name: (r.run_id, r.previous_run_id) for r in artifacts.current_pointers(spark, layout).collect()}


def test_a_file_is_created_once(spark):
    folder = base(spark)
    assert create_file(spark, f"{folder}/a.json", b"one") and not create_file(spark, f"{folder}/a.json", b"two")
    assert names(spark, folder) == ["a.json"] and spark.read.text(f"{folder}/a.json").first()[0] == "one"
    assert names(spark, f"{folder}/none") == []


def test_of_many_writers_one_creates_the_file(spark):
    folder = base(spark)
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: create_file(spark, f"{folder}/x.json", str(i).encode()), range(24)))
    assert sum(made) == 1 and spark.read.text(f"{folder}/x.json").first()[0] == str(made.index(True))


def test_commits_keep_the_run_before(spark):
    root = base(spark)
    for run, tables in (("r1", ["a", "b"]), ("r2", ["a"]), ("r3", ["a", "c"])):
        artifacts.commit_pointers(spark, RunLayout(root, run), tables, DAY)  # clocks that stand still
    layout = RunLayout(root, "")
    assert state(spark, layout) == {"a": ("r3", "r2"), "b": ("r1", None), "c": ("r3", None)}
    assert artifacts.read_pointers(spark, layout).count() == 5
    assert artifacts.current_pointers(spark, RunLayout(base(spark), "")).collect() == []


def test_commits_at_once_see_each_other(spark):
    root = base(spark)
    runs = [f"r{i}" for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda run: artifacts.commit_pointers(spark, RunLayout(root, run), ["t"], DAY), runs))
    history = artifacts.read_pointers(spark, RunLayout(root, "")).collect()
    before = {r.run_id: r.previous_run_id for r in history}
    assert set(before) == set(runs)
    chain, run = [], state(spark, RunLayout(root, ""))["t"][0]
    while run is not None:
        chain.append(run)
        run = before[run]
    assert sorted(chain) == sorted(runs)  # every commit but the first names the one before


def test_snapshots_bound_what_readers_open(spark, monkeypatch):
    monkeypatch.setattr(artifacts, "ENTRIES_PER_SNAPSHOT", 3)
    root = base(spark)
    for number in range(8):
        artifacts.commit_pointers(spark, RunLayout(root, f"r{number}"), ["a"] if number else ["a", "b"], DAY)
    layout = RunLayout(root, "")
    assert state(spark, layout) == {"a": ("r7", "r6"), "b": ("r0", None)}
    opened = artifacts.current_pointers(spark, layout).inputFiles()
    assert sorted(f.rsplit("/", 1)[1] for f in opened) == ["000000000006.json", "000000000007.json", "000000000008.json"]
    assert artifacts.read_pointers(spark, layout).count() == 9
