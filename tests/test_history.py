import random

from tidemill.operators.history import attribute_intervals, change_log, history, versions

SCHEMA = "id long, uid string, content string, content_hash string, captured_at string, _at string, _bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def run(spark, rows):
    found = history(frame(spark, rows), "uid", "captured_at", "id", ["content"])
    return sorted(tuple(r) for r in found.collect())


def brute(rows):
    from datetime import UTC, datetime

    states = {}
    for i, uid, content, _, at in rows:
        try:
            t = datetime.fromisoformat(at.strip()).astimezone(UTC) if at else None
        except ValueError:
            t = None
        if uid and t:
            states.setdefault(uid, {}).setdefault(t.strftime("%Y-%m-%dT%H:%M:%SZ"), []).append((i, content or ""))
    out = []
    for uid, own in states.items():
        kept, last = [], None
        for t in sorted(own):
            content = max(own[t])[1]
            if content != last:
                kept.append(t)
                last = content
        out += [(uid, a, b) for a, b in zip(kept, [*kept[1:], ""])]
    return sorted(out)


def test_versions_against_brute_force(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        day, second = rng.choice(["2025-09-01", "2025-12-31", "2026-04-02"]), rng.randrange(3)
        form = rng.choice(["{d}T10:00:0{s}Z", "{d}T10:00:0{s}.750Z", "{d}T17:00:0{s}+07:00", "{d} 05:00:0{s}-05:00"])
        rows.append((i, f"u{rng.randrange(6)}", rng.choice(["a", "b", "", None]), "h", form.format(d=day, s=second)))
    rows += rows[:50] + [(900, None, "x", "h", "2025-09-01T10:00:00Z"), (901, "u1", "x", "h", "never"), (902, "u1", "x", "h", None)]
    assert run(spark, rows) == brute(rows)


def test_text_that_comes_back_and_same_second(spark):
    rows = [(1, "u", "a", "h", "2025-09-01T00:00:00Z"), (2, "u", "b", "h", "2025-09-02T00:00:00Z"), (3, "u", "a", "h", "2025-11-30T00:00:00Z"), (4, "u", "x" * 100_000, "h", "2025-09-02T00:00:00.9Z")]
    assert run(spark, rows) == [
        ("u", "2025-09-01T00:00:00Z", "2025-09-02T00:00:00Z"),
        ("u", "2025-09-02T00:00:00Z", "2025-11-30T00:00:00Z"),
        ("u", "2025-11-30T00:00:00Z", ""),
    ]


def test_empty(spark):
    assert run(spark, []) == []


def test_two_attributes_split_at_the_union_of_their_times(spark):
    rows = [
        (1, "u", "a", "h1", "2025-01-01T00:00:00Z"),
        (2, "u", "a", "h2", "2025-06-01T00:00:00Z"),
        (3, "u", "b", "h2", "2025-07-01T00:00:00Z"),
        (4, "u", "b", "h2", "2025-12-01T00:00:00Z"),
    ]
    log = change_log(frame(spark, rows), "uid", "captured_at", "id", ["content", "content_hash"])
    both = sorted(tuple(r) for r in versions(log, "uid", ["content", "content_hash"]).collect())
    assert [v[1][:7] for v in both] == ["2025-01", "2025-06", "2025-07"] and both[-1][2] == ""
    each = sorted((r.attribute, r.valid_from[:7], r.valid_to[:7], r.order_no) for r in attribute_intervals(log, "uid").collect())
    assert each == [("content", "2025-01", "2025-07", 1), ("content", "2025-07", "", 3), ("content_hash", "2025-01", "2025-06", 1), ("content_hash", "2025-06", "", 2)]
