import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import pyarrow as pa

from tidemill.llm import forest as module
from tidemill.llm.forest import Forest, chance, repeats, sketch_agreement
from tidemill.llm.words import plain_words, runs, slices, word_hashes

SCHEMA = "uid string, source string, locale string, title string, content string, fetched_at string, doc string, rep string, chain int"


def test_plain_words():
    assert plain_words("<p>Café crème</p><i></i>&amp; ＵＳＤＴ e​ar­ly Đặng_x 3.5%") == ["cafe", "creme", "usdt", "early", "đang", "x", "3", "5"]
    assert plain_words("") == [] and plain_words("<<<>>> !!!") == [] and plain_words("a < b > c") == ["a", "b", "c"]


def test_runs_stay_inside_texts():
    texts = ["a b c d", "", "x", "a b c", "y z"]
    values, counts = runs(*word_hashes(texts), 3)
    assert counts.tolist() == [2, 0, 0, 1, 0] and len(values) == 3 and values[0] == values[2] != values[1]
    one, _ = runs(*word_hashes(["b c d"]), 3)
    assert one[0] == values[1] and len(runs(*word_hashes([]), 3)[0]) == 0 and np.all(runs(*word_hashes(["", "a"]), 2)[1] == 0)


def test_pieces_by_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["aa", None, "b" * 50, "c", "d"]})
    assert [b.column("t").to_pylist() for b in slices(iter([batch]), "t", 4)] == [["aa", None], ["b" * 50], ["c", "d"]]


def test_prefix_is_widened_to_the_recall_target(spark):
    assert chance(0.6, 4) < 0.975 <= chance(0.6, 3) and chance(0.95, 4) > 0.9
    with pytest.raises(ValueError):
        Forest(spark, threshold=0.1, recall=0.99)
    assert sketch_agreement(0.8) > sketch_agreement(0.6)


def brute(rows, run_words, percent):
    sets, chains = {}, defaultdict(set)
    for uid, source, locale, title, content, *_ in rows:
        if uid is not None and content is not None and content.strip():
            w = plain_words(f"{title or ''} {content}")
            own = {tuple(w[i : i + run_words]) for i in range(len(w) - run_words + 1)}
            if own:
                sets[uid] = own
                chains[source, locale].add(uid)
    return sorted(
        (min(a, b), max(a, b))
        for uids in chains.values()
        for a, b in itertools.combinations(sorted(uids), 2)
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    )


def made(n=260, seed=1):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 140))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            day = rng.choice(["2025-09-01", "2025-09-02", "2025-09-03"])
            rows.append((f"u{len(rows):04}", rng.choice(["A", "A", "B"]), rng.choice(["EN", None]), rng.choice(["T", None]), " ".join(words), f"{day}T00:00:00Z"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1) for r in rows], SCHEMA)


def test_against_brute_force(spark):
    rows = made()
    rows += rows[:40]  # redelivered
    rows += [("n1", "A", "EN", "T", None, None), ("n2", "A", "EN", "T", "  ", "2025-09-01T00:00:00Z"), ("n3", "A", "EN", None, "two words", "2025-09-01T00:00:00Z"), (None, "A", "EN", "T", rows[0][4], "2025-09-01T00:00:00Z")]
    expected = brute(rows, 3, 60)
    got = sorted(tuple(r) for r in repeats(frame(spark, rows)).collect())
    assert set(got) <= set(expected) and len(got) >= 0.99 * len(expected) > 50 and len(got) == len(set(got))


def test_copies_and_very_long_texts(spark):
    text = " ".join(f"x{i}" for i in range(50))
    rows = [(f"c{i}", "A", "EN", None, text, f"2025-09-0{1 + i % 3}T00:00:00Z") for i in range(30)]
    rows += [("long1", "A", "EN", None, " ".join(f"y{i}" for i in range(40_000)), "2025-09-01T00:00:00Z"), ("long2", "A", "EN", None, " ".join(f"y{i}" for i in range(40_010)), "2025-09-03T00:00:00Z")]
    got = {tuple(r) for r in repeats(frame(spark, rows)).collect()}
    assert len(got) == 30 * 29 // 2 + 1 and ("long1", "long2") in got


def test_empty_and_one_day(spark):
    assert repeats(frame(spark, [])).collect() == []
    assert len(repeats(frame(spark, [("a", "A", "EN", None, "one two three four", "2025-09-01T00:00:00Z"), ("b", "A", "EN", None, "One, two three FOUR", "2025-09-01T00:00:00Z")])).collect()) == 1


def batches(n=120, seed=2):
    return [(r[0], f"{r[1]}|{r[2]}", f"{r[3] or ''} {r[4]}") for r in made(n, seed)]


def frame3(spark, part):
    return spark.createDataFrame(part, "uid string, chain string, text string")


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_batches_do_not_matter_and_runs_are_merged(spark):
    rows = batches()
    forest, found = Forest(spark, run_words=3, threshold=0.6, most_runs=2), set()
    for i in range(4):
        found |= pairs(forest.add(frame3(spark, rows[i * 30 : (i + 1) * 30])))
    assert len(forest.note["runs"]) <= 2
    assert found == pairs(Forest(spark, run_words=3, threshold=0.6).add(frame3(spark, rows)))


def test_a_store_is_opened_again_and_batches_count_once(spark):
    rows = batches(60, 3)
    first = Forest(spark, run_words=3, threshold=0.6)
    one = pairs(first.add(frame3(spark, rows[:30]), "mon"))
    again = Forest(spark, first.path, run_words=3, threshold=0.6)
    two = pairs(again.add(frame3(spark, rows[30:]), "tue"))
    assert one | two == pairs(Forest(spark, run_words=3, threshold=0.6).add(frame3(spark, rows)))
    assert pairs(again.add(frame3(spark, rows[:30]), "mon")) == one and len(again.note["runs"]) == 2
    with pytest.raises(RuntimeError):  # a second writer with an old note
        first.add(frame3(spark, rows[:3]), "wed")
    with pytest.raises(ValueError):
        Forest(spark, first.path, run_words=5)


def test_exact_misses_none(spark):
    rows = made(150, 5)
    forest = Forest(spark, run_words=3, threshold=0.6, exact=True)
    texts = [(r[0], f"{r[1]}|{r[2]}", f"{r[3] or ''} {r[4]}") for r in rows]
    found = pairs(forest.add(frame3(spark, texts[:100]))) | pairs(forest.add(frame3(spark, texts[100:])))
    assert sorted(found) == brute(rows, 3, 60)


def test_hot_branches_and_shuffled_joins_give_the_same(spark, monkeypatch):
    words = [f"t{i}" for i in range(80)]
    rows = [(f"h{k}", "A", " ".join([*words, f"own{k}"])) for k in range(40)] + batches(40, 7)
    usual = pairs(Forest(spark, run_words=3, threshold=0.6).add(frame3(spark, rows)))
    assert len(usual) >= 40 * 39 // 2
    monkeypatch.setattr(module, "HOT_BRANCH", 5)
    monkeypatch.setattr(module, "at_hand", lambda df, *bounds: df)
    monkeypatch.setattr(module, "BUCKET_ROWS", 10)
    forest = Forest(spark, run_words=3, threshold=0.6)
    assert pairs(forest.add(frame3(spark, rows))) == usual and forest.note["runs"][0]["hot"] > 0


def test_words_of_history_are_read_where_candidates_lie_only(spark):
    """Of the parts of a large run, a batch with one near text reads one."""
    rows = batches(200, 9)
    forest = Forest(spark, run_words=3, threshold=0.6)
    forest.add(frame3(spark, rows).repartition(16), "history")
    texts = forest._texts(forest.note["runs"][0])
    assert texts.select("seg").distinct().count() > 4
    new = frame3(spark, [("new", rows[0][1], rows[0][2] + " and more words")])
    run = forest._write_run(new)
    forest.note = forest.note | {"runs": [*forest.note["runs"], run]}
    near = forest._searched(run)
    one = near[0].select("a1").union(near[0].select("b1")).toDF("d1").distinct()
    words = forest._words_of(one)
    plan = words._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S)
    parts = [set(re.findall(r"\b\d+\b", re.sub(r"#\d+", "", f))) for f in filters]
    assert any(parts) and all(len(p) <= 2 for p in parts) and words.count() == one.count()


def test_classes(spark):
    text = " ".join(f"x{i}" for i in range(60))
    rows = [("a", "A", text), ("b", "A", text), ("c", "A", text + " y"), ("d", "A", "quite another text"), ("e", "B", text)]
    forest = Forest(spark, run_words=3, threshold=0.6)
    assert Forest(spark).classes().count() == 0
    forest.add(frame3(spark, rows[:3]))
    forest.add(frame3(spark, rows[3:]))
    got = {r.uid: (r.class_id, r.n_links) for r in forest.classes().collect()}
    assert len({got[u][0] for u in "abc"}) == 1 and len({v[0] for v in got.values()}) == 3
    assert {u: v[1] for u, v in got.items()} == {"a": 2, "b": 2, "c": 2, "d": 0, "e": 0}
