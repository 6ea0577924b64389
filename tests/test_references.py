from datetime import datetime, timedelta

from reelspan.operators.references import Reference, orphan_references, orphan_report

T0 = datetime(2025, 1, 1)
REF = Reference("child", "cid", "pid", "parent", "pid")
CHILD = "cid string, pid string, ingested_at timestamp, deleted_at timestamp"
PARENT = "pid string, ingested_at timestamp, deleted_at timestamp"


def at(days):
    return T0 + timedelta(days=days)


def found(spark, child, parent):
    c = spark.createDataFrame(child, CHILD)
    p = spark.createDataFrame(parent, PARENT)
    return {(r["child_key"], r["reason"]) for r in orphan_references(c, p, REF).collect()}


def test_missing_withdrawn_late_and_restored(spark):
    parent = [
        ("live", at(0), None),
        ("gone", at(0), None), ("gone", at(5), at(5)),
        ("back", at(0), None), ("back", at(5), at(5)), ("back", at(6), None),
        ("late", at(9), None),
    ]
    child = [
        ("1", "live", at(1), None), ("2", "gone", at(1), None), ("3", "back", at(1), None), ("4", "late", at(1), None),
        ("5", "never", at(1), None), ("6", None, at(1), None), ("7", "", at(1), None), ("8", "late", at(10), None),
        ("1", "live", at(2), None), ("5", "never", at(3), None), ("9", "LIVE", at(1), at(2)),
    ]
    assert found(spark, child, parent) == {("2", "withdrawn"), ("4", "late"), ("5", "missing"), ("7", "missing"), ("9", "missing")}


def test_first_arrival_counts_for_late(spark):
    assert found(spark, [("1", "p", at(1), None), ("1", "p", at(8), None)], [("p", at(5), None)]) == {("1", "late")}
    assert found(spark, [("1", "p", at(5), None)], [("p", at(5), None)]) == set()


def test_null_times_and_empty_tables(spark):
    assert found(spark, [("1", "p", None, None)], [("p", at(5), None)]) == set()
    assert found(spark, [], [("p", at(5), None)]) == set()
    assert found(spark, [("1", "p", at(1), None)], []) == {("1", "missing")}


def test_report_counts_per_period_and_clashing_columns(spark):
    c = spark.createDataFrame([("1", "x", at(0), None, "a"), ("2", "x", at(40), None, "a"), ("3", "x", at(41), None, "a")], CHILD + ", reason string")
    p = spark.createDataFrame([], PARENT + ", reason string")
    rows = {(r["period"], r["reason"], r["orphan_rows"], r["orphan_keys"]) for r in orphan_report(orphan_references(c, p, REF)).collect()}
    assert rows == {("2025-01-01", "missing", 1, 1), ("2025-02-01", "missing", 2, 1)}
