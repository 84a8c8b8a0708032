import json
from datetime import date, datetime

import pytest

from tests.helpers import AS_OF, col, ref, table
from twinloom.errors import SpecError
from twinloom.operators.audit import audit_reports, parse_reports
from twinloom.operators.runs import latest_pointers, list_runs, next_pointers, protected_runs, runs_to_remove
from twinloom.plans.layout import RunLayout, new_run_id
from twinloom.plans.pipeline import latest_table, run_pipeline
from twinloom.sinks import artifacts
from twinloom.sources.texts import read_diagnostics


def report(**changes):
    base = {
        "run_id": "r",
        "checked_at": "now",
        "status": "MISMATCH",
        "summary": {
            "row_count": {"hive": 10, "iceberg": 8},
            "row_count_delta": 2,
            "exclusive_row_count": {"hive": 3, "iceberg": 1},
            "exclusive_row_ratio": {"hive": 0.3, "iceberg": 0.125},
        },
        "artifacts": {"hive_result_uri": "h", "iceberg_result_uri": "i"},
        "excluded_columns": {"hive": ["x"], "iceberg": [], "temporal": []},
    }
    for path, value in changes.items():
        node = base
        *parents, last = path.split("__")
        for name in parents:
            node = node[name]
        if value is ...:
            del node[last]
        else:
            node[last] = value
    return json.dumps(base)


def problem(spark, **changes):
    frame = spark.createDataFrame([(report(**changes), "r")], "payload string, asked string")
    return audit_reports(parse_reports(frame, expected_run="asked")).first()


def test_sound_reports(spark):
    row = problem(spark)
    assert row.problem is None and row.inconsistency is None and row.excluded_columns.hive == ["x"]
    row = problem(spark, excluded_columns=...)
    assert row.problem is None and row.excluded_columns.asDict() == {"hive": [], "iceberg": [], "temporal": []}


@pytest.mark.parametrize(
    "changes, fault",
    [
        ({"run_id": ""}, "run_id"),
        ({"run_id": "other"}, "run_id mismatch"),
        ({"status": "MAYBE"}, "unsupported status"),
        ({"checked_at": ...}, "checked_at"),
        ({"artifacts": ...}, "artifacts.hive_result_uri"),
        ({"summary__row_count_delta": 1.5}, "row_count_delta"),
        ({"summary__row_count__hive": True}, "row_count.hive"),
        ({"summary": ...}, "row_count.hive"),
        ({"excluded_columns__temporal": ...}, "excluded_columns.temporal"),
        ({"excluded_columns__hive": "x"}, "excluded_columns.hive"),
    ],
)
def test_structural_faults(spark, changes, fault):
    assert problem(spark, **changes).problem == fault


@pytest.mark.parametrize(
    "changes, fault",
    [
        ({"summary__row_count__hive": -1}, "row_count.hive negative"),
        ({"summary__exclusive_row_ratio__iceberg": 1.2}, "exclusive_row_ratio.iceberg outside 0..1"),
        ({"summary__exclusive_row_count__hive": 11}, "exclusive_row_count.hive above row_count"),
        ({"summary__row_count_delta": 3}, "row_count_delta"),
        ({"summary__exclusive_row_ratio__hive": 0.300002}, "exclusive_row_ratio.hive does not match"),
        ({"status": "MATCH"}, "status"),
    ],
)
def test_inconsistent_reports(spark, changes, fault):
    row = problem(spark, **changes)
    assert row.problem is None and row.inconsistency == fault


def pointers(spark, *rows):
    return spark.createDataFrame(
        [(t, r, p, datetime(2025, 1, d)) for t, r, p, d in rows],
        "table_name string, run_id string, previous_run_id string, updated_at timestamp",
    )


def ids(frame):
    return [r.run_id for r in frame.collect()]


def test_pointers(spark):
    history = pointers(spark, ("a", "r1", None, 1), ("a", "r2", "r1", 2), ("b", "r1", None, 1))
    latest = {r.table_name: (r.run_id, r.previous_run_id) for r in latest_pointers(history).collect()}
    assert latest == {"a": ("r2", "r1"), "b": ("r1", None)}
    commits = pointers(spark, ("a", "r3", None, 3), ("c", "r3", None, 3)).drop("previous_run_id")
    new = {r.table_name: r.previous_run_id for r in next_pointers(history, commits).collect()}
    assert new == {"a": "r2", "c": None}
    assert sorted(ids(protected_runs(latest_pointers(history)))) == ["r1", "r2"]
    with pytest.raises(Exception, match="Pointer without a run id: a"):
        protected_runs(pointers(spark, ("a", "", None, 1))).collect()


@pytest.mark.parametrize(
    "existing, protected, keep, removed",
    [
        ("12345", "", 2, "123"),
        ("12345", "1", 2, "234"),
        ("12345", "123", 2, "45"),
        ("12345", "9", 1, "1234"),
        ("12", "", 5, ""),
        ("1234", "4", 1, "123"),
    ],
)
def test_retention(spark, existing, protected, keep, removed):
    runs = spark.createDataFrame([(r,) for r in existing], "run_id string")
    current = pointers(spark, *((f"t{r}", r, None, 1) for r in protected))
    assert sorted(ids(runs_to_remove(runs, current, keep))) == list(removed)


def test_retention_needs_a_positive_number(spark):
    for keep in (0, -1, True, 1.5):
        with pytest.raises(SpecError):
            runs_to_remove(spark.createDataFrame([], "run_id string"), pointers(spark), keep)


def test_run_ids_sort_by_time():
    assert new_run_id(datetime(2024, 1, 2, 3, 4, 5)).startswith("20240102_030405_")
    assert new_run_id(datetime(2024, 1, 2)) < new_run_id(datetime(2024, 1, 3))


def contract(spark, folder, changed_sql=None):
    fields = {"p": "k bigint, load_day date, extra string", "c": "k bigint, v double"}
    tables = [
        table("p", 40, col("k", "INT", unique=True, digits_count=6), col("load_day", "DATE")),
        table("c", 100, ref("k", "p", "k"), col("v", "FLOAT", null_ratio=0.1)),
    ]
    for raw in tables:
        raw["write_mode"] = "OVERWRITE_TABLE"
        for engine in ("hive", "iceberg"):
            name = f"{folder.name.replace('-', '_')}_{engine}_{raw['table_name']}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields[raw['table_name']]}) USING PARQUET LOCATION '{folder}/{name}'")
            raw[f"{engine}_target_table"] = name
    sql = "SELECT p.k, count(*) AS n, sum(cast(v AS decimal(18,2))) AS v FROM {c} c JOIN {p} p USING (k) GROUP BY p.k"
    texts = {
        f"{engine}_sql": (changed_sql if changed_sql and engine == "iceberg" else sql).format(
            p=tables[0][f"{engine}_target_table"], c=tables[1][f"{engine}_target_table"]
        )
        for engine in ("hive", "iceberg")
    }
    return {"tables": tables, "queries": texts}


def test_pipeline_matches_publishes_and_retires(spark, tmp_path):
    base = str(tmp_path / "base")
    raw = contract(spark, tmp_path)
    results = [run_pipeline(spark, raw, base, AS_OF, seed=n, run_id=f"2025010{n}_000000_aaaaaaaa", keep_runs=2) for n in (1, 2, 3)]
    assert [r.report.first().status for r in results[1:]] == ["MATCH", "MATCH"]
    assert results[0].removed_runs == () and results[2].removed_runs == ("20250101_000000_aaaaaaaa",)
    layout = results[2].layout
    assert sorted(ids(artifacts.read_runs(spark, layout))) == ["20250102_000000_aaaaaaaa", "20250103_000000_aaaaaaaa"]
    assert not (tmp_path / "base" / "runs" / "20250101_000000_aaaaaaaa").exists()
    newest = latest_pointers(artifacts.read_pointers(spark, layout)).collect()
    assert {(r.table_name, r.run_id, r.previous_run_id) for r in newest} == {
        (t, "20250103_000000_aaaaaaaa", "20250102_000000_aaaaaaaa") for t in "pc"
    }
    data = latest_table(spark, base, "c")
    assert data.columns == ["k", "v"] and data.count() == 100 and data.where("v IS NULL").count() == 10
    assert latest_table(spark, base, "unknown") is None
    assert sorted(map(tuple, data.collect()), key=str) == sorted(map(tuple, spark.table(raw["tables"][1]["hive_target_table"]).collect()), key=str)


def test_only_single_runs_are_deleted(spark, tmp_path):
    for run_id in ("", " ", ".", "..", "a/b", "../x"):
        with pytest.raises(ValueError):
            artifacts.delete_run(spark, RunLayout(str(tmp_path), run_id))


def test_a_run_id_is_used_once(spark, tmp_path):
    raw = contract(spark, tmp_path)
    run_pipeline(spark, raw, str(tmp_path / "base"), AS_OF, run_id="run_1")
    with pytest.raises(SpecError, match="exists already"):
        run_pipeline(spark, raw, str(tmp_path / "base"), AS_OF, run_id="run_1")
    assert latest_table(spark, str(tmp_path / "base"), "p").count() == 40


def test_pipeline_mismatch_still_publishes(spark, tmp_path):
    raw = contract(spark, tmp_path, "SELECT p.k, cast(0 AS bigint) AS n, cast(1 AS decimal(28,2)) AS v FROM {p} p")
    result = run_pipeline(spark, raw, str(tmp_path / "base"), AS_OF)
    assert result.report.first().status == "MISMATCH"
    assert latest_table(spark, str(tmp_path / "base"), "p").count() == 40


def test_failed_load_leaves_a_diagnostic_and_no_pointer(spark, tmp_path):
    raw = contract(spark, tmp_path)
    raw["tables"][1]["iceberg_target_table"] = "no_such_table"
    layout = RunLayout(str(tmp_path / "base"), "run_x")
    with pytest.raises(Exception, match="no_such_table"):
        run_pipeline(spark, raw, layout.base, AS_OF, run_id="run_x")
    found = read_diagnostics(spark, layout.diagnostics).collect()
    assert [(r.task_id, r.code) for r in found] == [("load_iceberg", "TARGET_TABLE_NOT_FOUND")]
    assert artifacts.read_pointers(spark, layout).isEmpty()


def test_failed_staging_removes_the_run(spark, tmp_path):
    raw = contract(spark, tmp_path)
    raw["tables"][0]["columns"][1] = col("load_day", "DATE", "STRING", unique=True, date_format="%Y")
    with pytest.raises(SpecError):
        run_pipeline(spark, raw, str(tmp_path / "base"), date(2025, 1, 1), run_id="run_y")
    assert not (tmp_path / "base" / "runs" / "run_y").exists()
    assert list_runs(artifacts.read_runs(spark, RunLayout(str(tmp_path / "base"), ""))).isEmpty()
