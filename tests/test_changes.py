"""Differences between table states, replay, and change logs."""

from ledgerloom.operators.changes import METADATA, apply_changes, current_rows, table_changes
from support import tuples

SCHEMA = "k long, a string, b double"
OLD = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0), (4, "d", 4.0), (None, "n", 0.0), (5, None, None)]
NEW = [(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (None, "m", 0.0), (5, None, None), (6, "f", 6.0), (6, "f", 6.0)]


def test_actions(spark):
    changes = table_changes(spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA), ["k"])
    got = sorted((r["k"], r["a"], r["b"], r["metadata_action"], r["metadata_isupdate"]) for r in changes.filter("k is not null").collect() if r["b"])
    assert got == [
        (2, "b", 2.0, "INSERT", True), (3, "c", 3.0, "DELETE", False), (4, "d", 4.0, "DELETE", False),
        (6, "f", 6.0, "INSERT", False), (6, "f", 6.0, "INSERT", False),
    ]
    assert {(r["a"], r["metadata_action"], r["metadata_isupdate"]) for r in changes.filter("k is null").collect()} == {
        ("n", "DELETE", True), ("m", "INSERT", True),
    }
    ids = {r["metadata_row_id"] for r in changes.filter("k = 2").collect()}
    assert len(ids) == 1 and changes.filter("k = 2").count() == 2


def test_replay_gives_the_other_state(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    for a, b in ((old, new), (new, old), (old, old), (old.limit(0), new), (old, new.limit(0))):
        assert tuples(apply_changes(a, table_changes(a, b, ["k"]))) == tuples(b)
    assert table_changes(old, old, ["k"]).count() == 0
    assert {r["metadata_action"] for r in table_changes(None, old, ["k"]).collect()} == {"INSERT"}


def test_log_of_versions(spark):
    """Update, delete, insert again; a version stored twice changes nothing."""
    states = [[(1, "a", 1.0), (2, "b", 2.0)], [(1, "x", 1.0)], [(1, "x", 9.0), (3, "c", None)], [(2, "z", 0.0), (3, "c", None)]]
    frames = [spark.createDataFrame(s, SCHEMA) for s in states]
    log = None
    for version, after in enumerate(frames):
        part = table_changes(frames[version - 1] if version else None, after, ["k"]).selectExpr("*", f"{version}L AS version")
        log = part if log is None else log.unionByName(part).unionByName(part)
        assert tuples(current_rows(log, ["k"], "version")) == tuples(after)
    assert set(METADATA) < set(log.columns)


def test_hot_rows_meet_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("1L AS k", "'x' AS a", "0.0D AS b")
    plan = table_changes(rows, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Join" not in plan
