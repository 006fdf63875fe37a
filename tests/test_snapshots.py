from datetime import date, datetime

from tidemill.operators.snapshots import change_counts, changes

SCHEMA = "snapshot_date date, delivered_at timestamp, uid string, content_hash string, status string, _key string, change_kind int"
D = [date(2026, 1, d) for d in (5, 9, 20, 30)]


def run(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    found = changes(table, "uid", "snapshot_date", "delivered_at", ["content_hash", "status"])
    return sorted((str(r.snapshot_date), r.uid, r.change_kind) for r in found.collect())


def at(day, hour=2):
    return datetime(day.year, day.month, day.day, hour)


def test_added_removed_changed_and_returned(spark):
    rows = [(d, at(d), "always", "h", "new") for d in D]
    rows += [(D[0], at(D[0]), "gone", "h", "new"), (D[3], at(D[3]), "gone", "h", "new")]
    rows += [(D[1], at(D[1]), "late", "h", "new"), (D[2], at(D[2]), "late", "h2", "new"), (D[3], at(D[3]), "late", "h2", "changed")]
    assert run(spark, rows) == [
        ("2026-01-09", "gone", "removed"),
        ("2026-01-09", "late", "added"),
        ("2026-01-20", "late", "changed"),
        ("2026-01-30", "gone", "added"),
        ("2026-01-30", "late", "changed"),
    ]


def test_untidy_values_are_equal_and_later_deliveries_count(spark):
    rows = [(D[0], at(D[0]), "a", " ABC ", "New"), (D[1], at(D[1]), "a", "abc", "new "), (D[2], at(D[2], 2), "a", "wrong", "new"), (D[2], at(D[2], 9), "a", "abc", "NEW")]
    rows += [(D[0], at(D[0]), "b", None, "new"), (D[1], at(D[1]), "b", "", "new"), (D[2], at(D[2]), "b", None, "new")]
    assert run(spark, rows) == []


def test_nulls_ties_and_repeats(spark):
    rows = [(D[0], at(D[0]), None, "h", "new"), (None, at(D[0]), "a", "h", "new"), (D[0], None, "a", "x", "new"), (D[0], at(D[0]), "a", "h", "new")] * 3
    rows += [(D[1], at(D[1]), "a", "h", "new"), (D[1], at(D[1]), "a", "g", "new")]  # a tie: one of them stands, always the same
    assert run(spark, rows) == run(spark, list(reversed(rows)))


def test_empty_and_single_date(spark):
    assert run(spark, []) == []
    assert run(spark, [(D[0], at(D[0]), "a", "h", "new")]) == []


def test_counts(spark):
    table = spark.createDataFrame([(D[0], at(D[0]), "a", "h", "new"), (D[1], at(D[1]), "b", "h", "new")], "snapshot_date date, delivered_at timestamp, uid string, content_hash string, status string")
    found = change_counts(changes(table, "uid", "snapshot_date", "delivered_at", ["content_hash", "status"]), "snapshot_date")
    assert sorted((r.change_kind, r.n) for r in found.collect()) == [("added", 1), ("removed", 1)]
