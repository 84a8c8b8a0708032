"""Loading both engines at once."""

import threading
import time

import pytest

from twinloom.errors import LoadError
from twinloom.plans import pipeline
from twinloom.plans.layout import RunLayout
from twinloom.session import session_conf, session_like, shared_folder


def test_a_session_like_another_has_its_settings_and_keeps_its_own(spark):
    with session_conf(spark, {"spark.sql.shuffle.partitions": "3"}):
        session = session_like(spark)
        assert session.conf.get("spark.sql.shuffle.partitions") == "3"
        session.conf.set("spark.sql.ansi.enabled", "false")
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"
        assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def layout(spark):
    return RunLayout(shared_folder(spark, "engines"), "20250101_000000_00000000")


def test_engines_load_at_once_in_sessions_of_their_own(spark, monkeypatch):
    meet, sessions = threading.Barrier(2, timeout=60), {}

    def load(session, contract, layout, engine, stopped):
        sessions[engine] = session
        session.conf.set("spark.sql.storeAssignmentPolicy", "ANSI" if engine == "hive" else "LEGACY")
        meet.wait()  # passes only if both are here
        assert session.conf.get("spark.sql.storeAssignmentPolicy") == ("ANSI" if engine == "hive" else "LEGACY")

    monkeypatch.setattr(pipeline, "load_engine", load)
    before = spark.conf.get("spark.sql.storeAssignmentPolicy")
    pipeline.load_engines(spark, None, layout(spark))
    assert len({id(session) for session in (*sessions.values(), spark)}) == 3
    assert spark.conf.get("spark.sql.storeAssignmentPolicy") == before


def test_a_failure_cancels_the_other_engine(spark, monkeypatch):
    started = threading.Event()

    def load(session, contract, layout, engine, stopped):
        if engine == "hive":
            assert started.wait(60)
            time.sleep(1)
            raise LoadError("NO_TARGET", "hive has no such table")
        started.set()
        slow = session.range(8, numPartitions=8).selectExpr("reflect('java.lang.Thread', 'sleep', 25000L)")
        slow.collect()

    monkeypatch.setattr(pipeline, "load_engine", load)
    where, begun = layout(spark), time.monotonic()
    with pytest.raises(LoadError, match="no such table"):
        pipeline.load_engines(spark, None, where)
    assert time.monotonic() - begun < 20
    diagnostics = {r.task_id: r.code for r in spark.read.json(where.diagnostics).collect()}
    assert diagnostics == {"load_hive": "NO_TARGET"}
