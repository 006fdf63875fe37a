import hashlib

from pyspark.sql import functions as F

from tidemill.functions import keys, texts
from tidemill.operators import filters, groups, ingest, ranges, retrieval
from tidemill.streaming.ingest import Store, run

STATE = "uid string, content string, content_hash string, status string, fetched_at string, update_time string, push_status string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def state(spark, rows):
    return spark.createDataFrame(rows, STATE)


def test_keys(spark):
    row = spark.range(1).select(keys.joined_hash(F.lit("S"), F.lit("EN"), F.lit("1")).alias("a"), keys.content_hash(F.lit(None).cast("string")).alias("b"), keys.set_fingerprint(F.array(F.lit("y"), F.lit("x"))).alias("c")).first()
    assert tuple(row) == (sha("S_EN_1"), sha(""), sha("xy"))


def test_texts(spark):
    rows = [("<b> A  title </b>", "One. Two!\n\nThree", "https://x.example/en/announcements/a-b/?q=1#f"), (None, None, None), ("", "", "https://x.example/")]
    got = spark.createDataFrame(rows, "t string, s string, u string").select(texts.clean_title(F.col("t")), texts.same_title(F.col("t")), texts.sentences(F.col("s")), texts.slug(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("A  title", "<b> a title </b>", ["One.", "Two!", "Three"], "a-b"), ("(无标题)", "", None, None), ("(无标题)", "", [], None)]
    money = spark.createDataFrame([("$1,200.50 or 3,000 USDT or $1,200.50",)], "s string").select(texts.money(F.col("s")).alias("m")).first().m
    assert money == ["$1,200.50", "3,000 USDT"]


def test_upsert_laws(spark):
    old = state(spark, [("same", "a", sha("a"), "new", "1", None, "pushed"), ("moved", "a", sha("a"), "new", "1", "", "pushed"), ("kept", None, sha(""), "changed", "1", "2", "pushed"), ("tampered", "a", "wrong", "new", "1", None, "pushed")])
    new = spark.createDataFrame([("same", "a", "5"), ("moved", "x", "4"), ("moved", "b", "5"), ("fresh", None, "5"), ("tampered", "a", "5"), (None, "a", "5")], "uid string, content string, fetched_at string")
    after, archived = ingest.upsert(old, new)
    got = {r.uid: (r.content, r.status, r.fetched_at, r.update_time, r.push_status) for r in after.collect()}
    assert got == {
        "same": ("a", "new", "1", None, "pushed"), "moved": ("b", "changed", "1", "5", "pending"), "kept": (None, "changed", "1", "2", "pushed"),
        "fresh": (None, "new", "5", None, "pending"), "tampered": ("a", "changed", "1", "5", "pending"),
    }
    assert sorted((r.uid, r.content, r.captured_at) for r in archived.collect()) == [("moved", "a", "1"), ("tampered", "a", "1")]
    again, none = ingest.upsert(after, new)
    assert none.count() == 0 and sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)


def test_watermarks_versions_and_sync(spark):
    rows = spark.createDataFrame([("S", "EN", "3"), ("S", "EN", None), (None, "EN", "1"), ("T", "EN", None)], "source string, locale string, t string")
    first = ingest.watermarks(rows, ["source", "locale"], "t")
    assert {r.source: r.high_watermark for r in first.collect()} == {"S": "3", None: "1", "T": None}
    assert {r.source: r.high_watermark for r in ingest.watermarks(rows.where("t < '3'"), ["source", "locale"], "t", first).collect()}["S"] == "3"
    items = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "uid string, v string")
    known = spark.createDataFrame([("a", "1"), ("b", "1")], "uid string, v string")
    assert [r.uid for r in ingest.changed_versions(items, known, "uid", "v").collect()] == ["b"]
    desired, existing = spark.createDataFrame([("a", "1", ""), ("b", "2", "x"), ("n", "1", None)], "uid string, p string, q string"), spark.createDataFrame([("a", "1", None), ("b", "2", "y"), ("z", "1", "1")], "uid string, p string, q string")
    assert {r.uid: r.action for r in ingest.sync_actions(desired, existing, "uid", ["p", "q"]).collect()} == {"a": "skip", "b": "update", "n": "create", "z": "delete"}


def test_duplicates(spark):
    rows = [("u2", "S", "T", "h", "2"), ("u1", "S", "T", "h", "2"), ("u3", "S", "T", "h", "9"), ("u3", "S", "T", "h", "9"), ("u4", "S", "other", "h", "1"), ("u5", "S", None, "h", "1"), ("u6", "S", None, "h", "1"), ("u7", "S", "T", "", "1")]
    table = spark.createDataFrame(rows, "uid string, source string, title string, h string, at string")
    assert sorted(map(tuple, groups.duplicates(table, "uid", ["source", "title", "h"], F.col("at")).collect())) == [("u2", "u1"), ("u3", "u1")]


def test_groups(spark):
    rows = [("g1", "EN"), ("g1", "FR"), ("g2", "FR"), ("g3", "EN"), (None, "FR"), ("g4", None)]
    table = spark.createDataFrame(rows, "g string, locale string")
    assert {r.g: r.exclusive for r in groups.region_exclusive(table, "g", "locale").collect()} == {"g1": False, "g2": True, "g3": False, "g4": False}
    assert sorted(tuple(r) for r in groups.conflicting(table, ["g"], "locale").collect()) == [("g1", "EN", 2), ("g1", "FR", 2)]


def test_counted_once_and_variants(spark):
    rows = [("a", "g1", "S", "EN", "t", "1", "long text"), ("b", "g1", "S", "FR", "u", "2", "x"), ("c", "g2", "S", "FR", "t", "3", "x"), ("d", "g3", "S", "EN", "t", "4", "x"), ("e", None, "R", "EN", "t", "1", "x")]
    table = spark.createDataFrame(rows, "uid string, g string, source string, locale string, title string, at string, content string")
    kept = groups.counted_once(table, "uid", "g", "source", "locale", F.col("title"), F.col("at"))
    assert sorted(r.uid for r in kept.collect()) == ["a", "d", "e"]
    merged = {r.g: (r.n_rows, r.locales, r.representative) for r in groups.variants(table.where("g is not null"), ["g"], "uid", "locale", "content", ["EN", "FR"]).collect()}
    assert merged["g1"] == (2, "EN,FR", "a")


def test_reusable_needs_equal_sets(spark):
    rows = [("d", "EN", "g1"), ("d", "EN", "g2"), ("d", "FR", "g2"), ("d", "FR", "g1"), ("d", "FR", "g1"), ("d", "VN", "g1"), ("e", "FR", "g1")]
    table = spark.createDataFrame(rows, "day string, locale string, g string")
    assert [tuple(r) for r in groups.reusable(table, ["day"], "locale", "g").collect()] == [("d", "FR", 2)]


def test_trend_and_rankings(spark):
    table = spark.createDataFrame([("1", "x", "a"), ("1", "x", "a"), ("2", "y", "b"), (None, "x", "c")], "day string, kind string, k string")
    assert sorted(map(tuple, groups.daily_trend(table, "day", "kind", F.col("k")).collect())) == [("1", "x", 1), ("1", "y", 0), ("2", "x", 0), ("2", "y", 1)]
    rows = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9), ("c", 8)], "s string, n int")
    assert [tuple(r) for r in groups.top_capped(rows, [F.desc("n")], "s", 2, 3).collect()] == [("b", 9), ("c", 8), ("a", 4)]
    assert sorted((r.s, r.n, r.depth) for r in groups.round_robin(rows, ["s"], [F.desc("n")], 2).collect()) == [("a", 3, 1), ("a", 4, 0), ("b", 9, 0), ("c", 8, 0)]


def test_numbers_and_chunks(spark):
    rows = spark.createDataFrame([(f"{i:03}",) for i in range(101)], "k string").repartition(7)
    assert sorted((r.k, r.row_no) for r in ranges.numbered(rows, ["k"]).collect()) == [(f"{i:03}", i) for i in range(101)]
    assert ranges.chunked(rows, ["k"], 25).groupBy("chunk").count().count() == 5
    assert ranges.numbered(rows.limit(0), ["k"]).count() == 0


def test_recall(spark):
    q = spark.createDataFrame([(1, "alpha beta gamma"), (2, None), (3, "zz")], "i int, t string")
    rows = spark.createDataFrame([("a", "alpha"), ("b", "Alpha, beta"), ("b", "Alpha, beta"), ("c", None), ("d", "beta alpha alpha")], "k string, title string")
    assert sorted(map(tuple, retrieval.recall(q, "i", "t", rows, "k", "title", 2).collect())) == [(1, "b", 2, 1), (1, "d", 2, 2)]


def test_stream_takes_each_delivery_once(spark, tmp_path):
    store = Store(spark, state(spark, [("a", "x", sha("x"), "new", "1", None, "pushed"), ("q", "x", sha("x"), "new", "1", None, "pushed")]))
    schema = "uid string, content string, fetched_at string"
    spark.createDataFrame([("a", "y", "2"), ("b", "z", "2")], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "1"))
    deliveries = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    for _ in range(2):
        run(deliveries, store).awaitTermination(120)
    assert {r.uid: r.status for r in store.state().collect()} == {"a": "changed", "b": "new", "q": "new"}
    assert store.archive().count() == 1
    store.take(spark.createDataFrame([("c", "z", "3")], schema), 0)  # taken already
    assert store.state().count() == 3
    untouched = {b: f for b, f in store.note["parts"].items() if "start" in f}
    assert untouched  # parts without a key of the batch are not written again

    # another process goes on: the stream's batch numbers and the store's are those of the folder
    spark.createDataFrame([("a", "w", "3")], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "2"))
    again = Store(spark, path=store.path)
    run(deliveries, again).awaitTermination(120)
    assert {r.uid: r.content for r in again.state().collect()} == {"a": "w", "b": "z", "q": "x"} and again.archive().count() == 2


def test_a_batch_cut_short_counts_once(spark, monkeypatch):
    from tidemill.streaming import ingest as module

    store = Store(spark, state(spark, [("a", "x", sha("x"), "new", "1", None, "pushed")]))
    batch = spark.createDataFrame([("a", "y", "2"), (None, "z", "2")], "uid string, content string, fetched_at string")
    monkeypatch.setattr(module, "write_note", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    try:
        store.take(batch, 0)
    except OSError:
        pass
    monkeypatch.undo()
    again = Store(spark, path=store.path)
    assert again.done == -1 and again.state().first().content == "x" and again.archive().count() == 0
    again.take(batch, 0)
    assert again.state().first().content == "y" and again.archive().count() == 1


def test_merge_laws(spark):
    schema = "uid string, v string, raw string, post string, category string, fetched_at string"
    current = spark.createDataFrame([("a", "1", "r", None, "c", "1"), ("b", "1", "r", "p", "c", "1"), ("d", "1", "r", "p", "c", "1")], schema).withColumns({"status": F.lit("new"), "update_time": F.lit(None).cast("string"), "push_status": F.lit("pushed")})
    incoming = spark.createDataFrame([("a", "1", "s", "q", "x", "2"), ("b", "2", "r", None, "x", "2"), ("e", "1", "r", "p", "y", "2"), ], schema)
    once = ingest.merged(current, incoming, "uid", "v", ["raw"], ["post"], ["category"], "fetched_at")
    got = {r.uid: (r.action, r.v, r.raw, r.post, r.category, r.fetched_at, r.status, r.update_time, r.push_status) for r in once.collect()}
    assert got == {
        "a": ("moved", "1", "s", "q", "c", "1", "new", None, "pushed"), "b": ("changed", "2", "r", "p", "c", "1", "changed", "2", "pending"),
        "d": ("absent", "1", "r", "p", "c", "1", "new", None, "pushed"), "e": ("new", "1", "r", "p", "y", "2", "new", None, "pending"),
    }
    twice = ingest.merged(once.drop("action"), incoming, "uid", "v", ["raw"], ["post"], ["category"], "fetched_at")
    assert {r.uid: r.action for r in twice.collect()} == {"a": "unchanged", "b": "unchanged", "d": "absent", "e": "unchanged"}
    assert {r.uid: (r.status, r.update_time) for r in twice.collect()}["b"] == ("changed", "2")


def test_scan_above_watermark(spark):
    rows = spark.createDataFrame([("a", "S", "5"), ("b", "S", "6"), ("c", "T", "3"), ("d", "T", "4"), ("e", None, "9"), ("f", "S", None)], "k string, s string, t string")
    marks = ingest.watermarks(spark.createDataFrame([("S", "5"), (None, "8")], "s string, t string"), ["s"], "t")
    assert sorted(r.k for r in filters.newer(rows, ["s"], "t", marks, "3").collect()) == ["b", "d", "e"]
    assert sorted(r.k for r in filters.newer(rows, ["s"], "t", marks, "3", full=True).collect()) == ["a", "b", "c", "d", "e"]


def test_fresh(spark):
    rows = spark.createDataFrame([("new", "2026-06-01T00:00:00Z", "2026-06-10"), ("new", "2026-06-08T00:00:00Z", "2026-06-10"), ("Changed ", "2020-01-01", "2026-06-10"), ("new", None, "2026-06-10"), (None, "2026-06-09", None)], "status string, p string, d string")
    assert [r.fresh for r in filters.fresh(rows, "status", "p", "d").collect()] == [False, True, True, True, False]


def test_late_copies(spark):
    rows = [("b", "S", "2"), ("c", "S", "3"), ("d", "S", "4"), ("a", "S", "1")]
    table = lambda part: spark.createDataFrame(part, "k string, same string, o string")
    marks = groups.duplicates(table(rows[:2]), "k", ["same"], F.col("o"))
    third = ingest.marked_again(table(rows[:3]), "k", ["same"], F.col("o"), marks)
    assert {tuple(r) for r in third.collect()} == {("c", "b"), ("d", "b")}
    earlier = ingest.marked_again(table([*rows[:2], rows[3]]), "k", ["same"], F.col("o"), marks)
    assert {tuple(r) for r in earlier.collect()} == {("c", "b"), ("b", "a")}


def test_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.createDataFrame([(f"k{i}", "S", str(i % 3)) for i in range(30)], "k string, s string, o string")
    usual = {tuple(r) for r in groups.duplicates(rows, "k", ["s"], F.col("o")).collect()}
    monkeypatch.setattr(groups, "at_hand", lambda df, *more: df)
    assert {tuple(r) for r in groups.duplicates(rows, "k", ["s"], F.col("o")).collect()} == usual and len(usual) == 29


def test_classified(spark):
    from tidemill.operators import classify

    rows = spark.createDataFrame([("1", "S", "a", "x"), ("2", "S", "b", "Now DELISTING this"), ("3", "S", "b", "relisted"), ("4", "S", "z", "list of 下架"), ("5", None, "a", None)], "k string, source string, raw string, title string")
    mapping = spark.createDataFrame([("S", "a", "listing"), ("S", "b", "other")], "source string, raw string, category string")
    got = {r.k: (r.layer, r.found_category) for r in classify.classified(rows, ["source", "raw"], "title", mapping, {"delisting": ["delisting", "下架"], "listing": ["list"]}).collect()}
    assert got == {"1": ("native", "listing"), "2": ("keyword", "delisting"), "3": ("native_other", "other"), "4": ("keyword", "delisting"), "5": ("unmapped", None)}
    usual = spark.createDataFrame([("S", "x"), ("S", "y"), ("S", "y"), ("T", "b"), ("T", "a"), (None, "a")], "source string, category string")
    assert {r.source: r.category for r in classify.usual_mapping(usual, ["source"], "category").collect()} == {"S": "y", "T": "a"}


def test_landing_and_exports(spark, tmp_path):
    from tidemill.plans.payloads import children
    from tidemill.sources.landing import captured, export_csv, export_json, since

    (tmp_path / "in" / "day").mkdir(parents=True)
    (tmp_path / "in" / "day" / "a.json").write_text('{"data": {"activityCenterInfoVos":\n [{"activityId": 7}]}}')
    (tmp_path / "in" / "b.json").write_text("")
    rows = captured(spark, str(tmp_path / "in"), "bingx_events_api")
    assert [tuple(r)[1:] for r in children(rows).collect()] == [("activity", "", "7")]
    table = spark.createDataFrame([("a", None, "2026"), ("b", "2024", "2026"), ("c", "", ""), ("d", "", "2025")], "k string, u string, p string")
    assert {r.k: r.kept for r in since(table, "u", "p", "2025").collect()} == {"a": True, "b": False, "c": False, "d": True}
    nested = table.select("k", F.array("u", "p").alias("list"))
    export_json(nested, str(tmp_path / "j"))
    export_csv(nested, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4 and spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).where("list like '[%'").count() == 4
