from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.llm import jaccard as j
from tidewarden.llm.components import components

WORDS = [f"w{i}" for i in range(3000)]


def plain_set(text):
    words = (text or "").split()
    size = min(5, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain_classes(rows, least=0.8):
    """Brute force over all pairs of rows."""
    sets = [plain_set(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for y in range(len(rows)):
        for x in range(y):
            both = len(sets[x] & sets[y])
            if sets[x] == sets[y] or both >= least * (len(sets[x]) + len(sets[y]) - both) > 0:
                links[x] += 1
                links[y] += 1
                a, b = top(x), top(y)
                root[max(a, b)] = min(a, b)
    least_id = {}
    for x, (key, _) in enumerate(rows):
        if key is not None:
            least_id[top(x)] = min(key, least_id.get(top(x), key))
    return sorted(((key, least_id.get(top(x)), links[x]) for x, (key, _) in enumerate(rows)), key=str)


def edited(words, changes):
    words = list(words)
    for _ in range(changes):
        words[random.randrange(len(words))] = random.choice(WORDS)
    return " ".join(words)


def corpus(seed=1):
    random.seed(seed)
    texts = []
    passage = random.choices(WORDS, k=60)
    for _ in range(25):  # families of near copies, some below the threshold
        base = random.choices(WORDS, k=random.choice([8, 30, 120, 400]))
        texts += [edited(base, random.choice([0, 0, 1, 2, 4, 8])) for _ in range(random.randint(1, 6))]
    texts += [" ".join(passage + random.choices(WORDS, k=60)) for _ in range(60)]  # a shared passage
    big = random.choices(WORDS, k=150)
    texts += [edited(big, random.randint(1, 4)) for _ in range(150)]  # over two blocks
    texts += ["exact copy of one two three"] * 90 + ["", None, "  ", "short", "short", "a b", "a  b\n"]
    ids = random.sample(range(5000), len(texts))
    return list(zip(ids, texts))


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "class_id", F.lit("clash")).withColumn("digest", F.lit(1)).repartition(6)
    got = j.jaccard_classes(df, **options).collect()
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str)


def test_classes_and_links_equal_brute_force(spark):
    rows = corpus()
    assert found(spark, rows) == plain_classes(rows)


def test_odd_ids_and_repeated_rows(spark):
    long = " ".join(WORDS[:50])
    rows = [(None, long), (4, long + " x"), (7, "only null ids are like this one here"),
            (9, long), (9, long), (9, "another text of the very same id"), (None, "lonely words")]
    assert found(spark, rows) == plain_classes(rows)
    only = [(None, "one two three four five six"), (None, "one two three four five six")]
    assert found(spark, only) == [(None, None, 1), (None, None, 1)]


def test_empty_table(spark):
    assert found(spark, []) == []
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert j.representatives(empty).collect() == []


def test_one_of_each_class_stays(spark):
    rows = [*corpus(2), (77_777, "a row that is repeated"), (77_777, "a row that is repeated")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash"))
    kept = j.representatives(df).collect()
    wanted = {c for _, c, _ in plain_classes(rows)}
    assert sorted(r.doc_id for r in kept) == sorted(wanted)
    texts = dict(rows)
    assert all(texts[r.doc_id] == r.text and r.id == "clash" for r in kept)


def test_signatures_estimate_similarity():
    random.seed(6)
    base = random.choices(WORDS, k=400)
    for changes in (2, 10, 40):
        one, two = " ".join(base), edited(base, changes)
        a, b = plain_set(one), plain_set(two)
        share = (j.signature(j.shingles(one)) == j.signature(j.shingles(two))).mean()
        assert share == pytest.approx(len(a & b) / len(a | b), abs=0.12)


def test_shingles_are_the_distinct_runs_of_words():
    random.seed(8)
    for _ in range(50):
        text = "".join(random.choice(["a", "bé", "c", " ", "\n", "\x0b ", " "]) for _ in range(80))
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        size = min(5, len(words))
        runs = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()
        assert len(j.shingles(text)) == len(runs)
    long = " ".join(random.choices(WORDS, k=30_000))
    assert len(j.shingles(long)) == len(plain_set(long))
    tail = " ".join(long.split()[-5:])
    assert j.shingles(tail)[0] in j.shingles(long)
    assert not len(j.signature(np.zeros(0, np.uint64)).nonzero()[0])


def test_the_prefix_is_shortened_until_the_recall_is_reached(spark):
    def pairs(rows):
        return spark.createDataFrame([(i, -i, d, s) for i, (d, s) in enumerate(rows)],
                                     "a long, b long, depth int, agreement double")

    assert j.chosen_depth(pairs([(8, 1.0)] * 10)) < j.DEPTH
    deep = j.chosen_depth(pairs([(8, 1.0)] * 10), target=0.9)
    assert deep > j.chosen_depth(pairs([(8, 1.0)] * 5 + [(4, 0.8)] * 5), target=0.9)
    assert j.chosen_depth(pairs([])) >= j.FLOOR
    assert j.chosen_depth(pairs([(4, 0.8)] * 9)) == j.FLOOR


def signed(spark, rows):
    return spark.createDataFrame(
        [(i.to_bytes(16), np.array(row, ">u2").tobytes()) for i, row in enumerate(rows)],
        "digest binary, signature binary")


def test_all_texts_of_a_long_run_are_compared(spark):
    """Alike texts that share one prefix only, with other texts between them."""
    rng = np.random.default_rng(3)
    alike = rng.integers(0, 60_000, j.TREES * j.DEPTH)
    rows = [alike.copy() if i in (0, 9) else rng.integers(0, 60_000, j.TREES * j.DEPTH)
            for i in range(10)]
    for i, row in enumerate(rows):
        row[:j.DEPTH] = [1, 2, 3, 4, 5, 6, 7 + i, 0]
        row[j.DEPTH::j.DEPTH] = 60_001 + i
    texts = signed(spark, rows)
    ends = (bytes(16), (9).to_bytes(16))
    assert ends not in {(r.a, r.b) for r in j.trie_pairs(texts).collect()}
    got = {r.digest: r.family for r in j.candidate_families(texts).collect()}
    assert {bytes(k) for k in got} == set(ends) and len(set(map(bytes, got.values()))) == 1
    placed = texts.withColumn("family", F.col("digest"))
    for block in (2, 100):
        links = j.run_links(placed, 6, block=block).collect()
        assert {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in links} == {ends}


def test_a_pair_found_by_a_short_prefix_only_stays(spark):
    """Many pairs found by whole paths make the chosen prefix long."""
    rng = np.random.default_rng(4)
    rows = [row for row in rng.integers(0, 60_000, (1_200, j.TREES * j.DEPTH)) for _ in range(2)]
    last = rows[-1].copy()
    last[4::j.DEPTH] = 60_001
    rows[-1] = last
    texts = signed(spark, rows)
    pairs = j.agreement(j.trie_pairs(texts), texts)
    assert j.chosen_depth(pairs) > pairs.agg(F.min("depth")).first()[0] == 4
    got = {bytes(r.digest): bytes(r.family) for r in j.candidate_families(texts).collect()}
    assert got[(2_399).to_bytes(16)] == got[(2_398).to_bytes(16)]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, i) for i in range(1001, 1100)]
    edges = spark.createDataFrame([*chain, *hub, (5, 5)], "a long, b long")
    got = {r.id: r["class"] for r in components(edges).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(1000, 1100)} == {1000} and got[5] == 5


def test_components_of_random_graphs(spark):
    random.seed(12)
    pairs = [(random.randrange(120), random.randrange(120)) for _ in range(90)]
    root = {i: i for pair in pairs for i in pair}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    edges = spark.createDataFrame(pairs, "a long, b long")
    assert {r.id: r["class"] for r in components(edges).collect()} == {i: top(i) for i in root}
    assert components(edges.limit(0)).collect() == []
