from tidemill.plans import reference_queries as R

ROWS = "uid string, source string, locale string, title string, content string, content_hash string, post_time string, update_time string, fetched_at string"


def folder(spark, path, times):
    """Announcements of one text with (uid, post_time, update_time), their source writing days first in New York."""
    rows = [(u, "S", "EN", "T", "x", "h", p, t, f"2026-02-01T00:00:{n:02}Z") for n, (u, p, t) in enumerate(times)]
    spark.createDataFrame(rows, ROWS).write.parquet(f"{path}/announcements.parquet")
    clocks = spark.createDataFrame([("S", "EN", "America/New_York", "dmy")], "source string, locale string, zone_name string, date_order string")
    clocks.write.parquet(f"{path}/source_clocks.parquet")
    return str(path)


def test_lookback_compares_instants(spark, tmp_path):
    kept = ["2026-01-01T00:00:00Z", "1767312000", "05/01/2026", "2025-12-31T23:30:00-05:00", "Mon, 05 Jan 2026 10:00:00 GMT"]
    skipped = ["2025-12-31T23:59:59Z", "1766000000", "31/12/2024", "2026-01-01T00:30:00+08:00", "Mon, 01 Dec 2025 10:00:00 GMT", "unknown", "", None]
    times = [(f"u{n}", t, None) for n, t in enumerate([*kept, *skipped])] + [(None, kept[1], ""), ("v", kept[0], skipped[0]), ("w", skipped[0], kept[1]), ("x", kept[0], "unknown")]
    got = R.QUERIES["lookback_counts_by_instant"](spark, folder(spark, tmp_path, times)).collect()
    assert [tuple(r) for r in got] == [("S", len(kept) + 3, len(skipped) + 1)]


def test_first_copy_by_instant(spark, tmp_path):
    times = [("a", "2026-01-02T00:00:00Z", None), ("b", "31/12/2025", None), ("c", "1767312001", None), ("d", "unknown", None), ("e", None, None), ("b", "31/12/2025", None)]
    got = R.QUERIES["exact_duplicates_by_instant"](spark, folder(spark, tmp_path, times)).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "b"), ("b", None), ("c", "b"), ("d", "b"), ("e", "b")]
