import random
from collections import Counter, defaultdict

from tidemill.llm import mixing, postings
from tidemill.llm.words import plain_words
from tidemill.operators import ranges
from tidemill.session import new_path

DOCS = "doc_id long, text string, doc string, term int, item int"
ITEMS = "item_id long, text string, place string"


def leaked(spark, docs, items, length):
    d = spark.createDataFrame([(*x, "c", 1, 2) for x in docs], DOCS)
    i = spark.createDataFrame([(*x, "c") for x in items], ITEMS)
    index = postings.kept(d, "doc_id", "text", new_path(spark, "index"))
    return sorted(tuple(r) for r in postings.phrases(index, d, "doc_id", "text", i, "item_id", "text", length).collect())


def test_phrases_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("a b c d e f g h".split()) + str(rng.choice([0, 0, 0, 1, 2, 3]))
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 25)))) for i in range(25)] + [(90, None), (91, ""), (None, "a b c"), (92, "one two")]
    docs = []
    for n in range(250):
        words = [word() for _ in range(rng.randint(0, 40))]
        if n % 3 == 0:
            own = plain_words(rng.choice(items[:25])[1])
            start = rng.randrange(max(1, len(own) - 5))
            words[len(words) // 2 : len(words) // 2] = own[start : start + rng.randint(4, 12)]
        docs.append((n, "<b>" + " ".join(words).upper() + "</b>"))
    docs += [(900, None), (901, ""), (None, docs[0][1]), docs[0]]
    expected = set()
    for i, text in items:
        if i is None or not text:
            continue
        w = plain_words(text)
        grams = {tuple(w[k : k + 6]) for k in range(len(w) - 5)}
        for n, body in docs:
            v = plain_words(body or "")
            if n is not None and any(tuple(v[k : k + 6]) in grams for k in range(len(v) - 5)):
                expected.add((n, i))
    assert leaked(spark, docs, items, 6) == sorted(expected) and len(expected) > 20


def test_nothing_between_and_in_order(spark):
    items = [(1, "one two three four five six")]
    docs = [(1, "zero one two three four five"), (2, "one two three x four five six"), (3, "six five four three two one"), (4, "one two three four"), (5, "One-two, three; FOUR &amp; five. " * 3000)]
    assert leaked(spark, docs, items, 5) == [(1, 1), (5, 1)]


def test_empty_tables(spark):
    assert leaked(spark, [], [(1, "one two three")], 2) == [] and leaked(spark, [(1, "one two three")], [], 2) == []


def test_appended_segments_and_blocks_of_test_texts(spark, monkeypatch):
    rng = random.Random(8)
    texts = [(n, " ".join(rng.choice("a b c d e f".split()) for _ in range(60))) for n in range(120)]
    items = spark.createDataFrame([(i, " ".join(rng.choice("a b c d e f".split()) for _ in range(20))) for i in range(30)], "item_id long, text string")
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    whole = postings.kept(frame(texts), "doc_id", "text", new_path(spark, "index"))
    path = new_path(spark, "index")
    for k in range(3):
        grown = postings.append(frame(texts[k * 40 : k * 40 + 40]), "doc_id", "text", path)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    look = lambda index: (rows(postings.phrases(index, frame(texts), "doc_id", "text", items, "item_id", "text", 4)), rows(postings.proximities(index, items, "item_id", "text")))
    expected = look(whole)
    assert rows(grown.terms.select("term", "n_docs")) == rows(whole.terms.select("term", "n_docs")) and expected[0] and expected[1]
    monkeypatch.setattr(postings, "BLOCK_WORDS", 100)
    monkeypatch.setattr(postings, "at_hand", lambda df, *bounds, **more: df)
    assert look(grown) == expected


def test_layers_without_a_wanted_term_are_not_read(spark):
    docs = spark.createDataFrame([(n, f"common words here rare{n}") for n in range(200)], "doc_id long, text string")
    index = postings.kept(docs, "doc_id", "text", new_path(spark, "index"))
    wanted = postings.with_frequencies(postings.test_words(spark.createDataFrame([(1, "rare7 rare8")], "i long, t string"), "i", "t"), index)
    plan = postings._searched(index, wanted, lambda t: t.select(["term"]), "term long")._jdf.queryExecution().executedPlan().toString()
    assert "band" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and [r[0] for r in wanted.select("bands").collect()] == [[0], [0]]


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta x gamma delta y epsilon zeta eta"), (2, "alpha " + "x " * 60 + "beta gamma"), (3, None)], "doc_id long, text string")
    assert [(r.doc, r.item) for r in postings.proximities(postings.kept(docs, "doc_id", "text", new_path(spark, "index")), items, "item_id", "text").collect()] == [(1, 1)]


def test_proximity_meets_every_part(spark):
    """A part that leaked often has frequent terms, one that leaked once has few of the item's rarest; both are met."""
    part = {n: " ".join(f"{n}{i}" for i in range(14)) for n in "abcde"}
    items = spark.createDataFrame([(1, " ".join(part.values())), (2, None), (3, "a0 a1")], "item_id long, text string")
    often = [(n, f"w{n} " * 5 + part["b"]) for n in range(40)]
    loose = part["d"].replace("d7", "d7 and then").replace("d3", "d3 x")
    docs = [*often, (50, part["d"]), (51, loose), (52, " ".join(reversed(part["d"].split()))), (53, "c1 " + "x " * 30 + "c2 c3 c4"), (54, " ".join(part.values())), (55, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = postings.proximities(postings.kept(docs, "doc_id", "text", new_path(spark, "index")), items, "item_id", "text").collect()
    assert sorted((r.doc, r.item, r.n_terms) for r in found) == [*((n, 1, 8) for n in range(40)), (50, 1, 8), (51, 1, 8), (54, 1, 8)]


SIZED, TARGETS = "key long, source string, n_tokens long", "source string, target_share double, max_repeats int"


def mixed(spark, sized, targets, **more):
    rows = mixing.mix(spark.createDataFrame(sized, SIZED), spark.createDataFrame(targets, TARGETS), **more).collect()
    return sorted(rows, key=lambda r: r.starts_at)


def test_shares_caps_and_budget(spark):
    rng = random.Random(1)
    sized = [(i, "big", rng.randint(50, 150)) for i in range(2000)] + [(10_000 + i, "small", 100) for i in range(50)] + [(20_000 + i, "unwanted", 100) for i in range(300)]
    targets = [("big", 0.5, 2), (" Small ", 0.4, 3), ("absent", 0.1, 5)]
    rows = mixed(spark, sized, targets)
    budget, tokens = sum(s[2] for s in sized), Counter()
    place = 0
    for r in rows:  # no gap, no overlap
        assert r.starts_at == place
        place += r.n_tokens
        tokens[r.source] += r.n_tokens
    assert budget - 150 < place <= budget and set(tokens) == {"big", "small"}
    copies = defaultdict(set)
    for r in rows:
        assert r.copy not in copies[r.key]
        copies[r.key].add(r.copy)
    assert tokens["small"] == 3 * 50 * 100  # all its repeats, less than its share
    assert max(map(len, (copies[s[0]] for s in sized if s[1] == "big"))) <= 2


def test_shares_hold_at_every_place(spark):
    sized = [(i, "a" if i % 2 else "b", 10) for i in range(4000)]
    rows = mixed(spark, sized, [("a", 0.7, 3), ("b", 0.3, 3)])
    half = Counter(r.source for r in rows[: len(rows) // 2])
    assert abs(half["a"] / sum(half.values()) - 0.7) < 0.01 and [r.key for r in rows] == [r.key for r in mixed(spark, sized, [("a", 0.7, 3), ("b", 0.3, 3)])]
    assert [r.key for r in rows] != [r.key for r in mixed(spark, sized, [("a", 0.7, 3), ("b", 0.3, 3)], seed=9)]


def test_mix_of_nothing_and_odd_rows(spark):
    assert mixed(spark, [], [("a", 1.0, 1)]) == [] and mixed(spark, [(1, "a", 5)], []) == []
    rows = mixed(spark, [(1, "a", 5), (1, "a", 5), (2, "a", 0), (None, "a", 5), (3, None, 5)], [("a", 1.0, None), ("a", 0.5, 2), ("z", None, 1)])
    assert [(r.key, r.copy) for r in rows] == [(1, 0), (1, 0)]


def test_one_tiny_weight_does_not_crowd_the_others(spark):
    """A source of weight 1e-7 stretches the axis of finish times; the ranges still hold about equally many records."""
    sized = [(i, "abcd"[i % 4], 100) for i in range(4000)] + [(9000 + i, "tiny", 100) for i in range(40)]
    targets = [(s, 0.25, 2) for s in "abcd"] + [("tiny", 1e-7, 3)]
    laid = []
    own = mixing.running_sum
    mixing.running_sum = lambda rows, *more: laid.append(rows) or own(rows, *more)
    try:
        rows = mixed(spark, sized, targets)
    finally:
        mixing.running_sum = own
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is, it would be one range
    parts = ranges.laid_out(laid[0], ["_finish"], "n_tokens").groupBy("_part").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 0.4 * sum(r["count"] for r in parts)
    assert sum(r.n_tokens for r in rows) == 404_000 and laid[0].count() < 4200  # of 8,120 copies


def test_tokens_and_report(spark):
    docs = spark.createDataFrame([(1, "Hello world", " A "), (2, None, "a"), (3, "", None), (4, "x" * 200_000, "b")], "doc_id long, text string, source string")
    sized = mixing.with_tokens(docs, "doc_id", "text", "source", "/opt/tokenizers/byte_bpe_50k.tiktoken")
    got = {r.key: (r.source, r.n_tokens) for r in sized.collect()}
    assert got[1] == ("a", 2) and got[2] == ("a", 0) and got[3] == ("", 0) and got[4][1] > 0
    targets = spark.createDataFrame([("a", 0.5, 1), ("c", 0.5, 1)], TARGETS)
    report = {r.source: (r.n_records, r.n_tokens, r.share) for r in mixing.shares(mixing.mix(sized, targets), targets).collect()}
    assert report == {"a": (1, 2, 1.0), "c": (0, 0, 0.0)}
