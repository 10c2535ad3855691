"""Chat collapse, quality rules, mixing and URL filters on hand-made tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewarden.llm import chat, mixing, rules, urls

CHAT = "conv_id long, turn long, role string, text string, rank string"


def conversation(key, *texts, start=0):
    return [(key, start + i, "user" if i % 2 == 0 else "assistant", t, "clash")
            for i, t in enumerate(texts)]


def plain_chat(rows):
    by = {}
    for key, turn, role, text, _ in set(rows):
        by.setdefault(key, []).append((turn is None, turn or 0, role or "", text or ""))
    whole = {key: tuple(t[2:] for t in sorted(turns)) for key, turns in by.items()}
    kept = {}
    for key, turns in whole.items():
        if not any(len(o) > len(turns) and o[:len(turns)] == turns for o in whole.values()):
            if turns not in kept or (kept[turns] is None or (key is not None and key < kept[turns])):
                kept[turns] = key
    return {key: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)
            for turns, key in kept.items()}


def collapsed(spark, rows, **options):
    got = chat.collapse_snapshots(spark.createDataFrame(rows, CHAT).repartition(3), **options).collect()
    texts = {}
    for r in sorted(got, key=lambda r: r.piece):
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
    return texts


@pytest.mark.parametrize("block", [2, 64])
def test_only_maximal_conversations_stay(spark, block):
    rows = [*conversation(1, "a", "b"), *conversation(2, "a", "b", "c"), *conversation(3, "a", "b", "c"),
            *conversation(4, "a", "x"), *conversation(5, "a"), *conversation(6, "b"),
            *conversation(10, "a", "b", "c", "d", "e", "f", "g"),
            *conversation(11, "a", "b", "c", "d", "e", "f", start=1),
            *conversation(None, "n"), *conversation(12, None, ""), *conversation(13, "", "", "z"),
            *conversation(2, "a", "b", "c"), (14, None, "user", "late", ""), (14, 0, "user", "x", ""),
            (14, 0, "user", "w", ""), (15, 3, None, "only", "")]
    assert collapsed(spark, rows, block=block) == plain_chat(rows)


def test_random_chats(spark):
    random.seed(9)
    rows = []
    for key in range(80):
        rows += conversation(key, *random.choices("ab", k=random.randint(1, 7)))
    assert collapsed(spark, rows, block=3) == plain_chat(rows)
    assert collapsed(spark, []) == {}


DOCS = "doc_id long, text string, lang string, source string, n_words string"


def plain_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    places = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
              for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(places))


def test_counts_of_texts(spark):
    random.seed(4)
    texts = [None, "", "  \n\t", "a", "a b", "a b c", "a a a", "a a a a", "x\ny\nx\n \n \nx",
             "é|é #<&>%$* b", "b " * 5000, "\u00a0 nbsp\u2003em  z\x0b\x0cq\r\nq"]
    texts += ["".join(random.choice("ab \n#") for _ in range(random.randint(1, 200))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en", "s", "x") for i, t in enumerate(texts)], DOCS)
    for r in rules.base_counts(df).collect():
        n = plain_counts(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])


def test_thresholds_follow_their_group(spark):
    random.seed(5)

    def text(word, junk):
        return " ".join(random.choice(word) + str(random.randint(0, 10 ** 6)) + junk for _ in range(90))

    rows = [(i, text(["ab", "cde"], ""), "en", "a", "x") for i in range(60)]
    rows += [(100 + i, text(["ab"], "#%"), "en", "a", "x") for i in range(25)]  # junk of a third
    rows += [(200 + i, text(["ab"], "#%"), "xx", "code", "x") for i in range(60)]  # usual there
    rows += [(300 + i, text(["ab"], ""), None, None, "x") for i in range(3)]
    rows += [(400, None, "en", "a", "x"), (5, rows[5][1], "en", "a", "x")]
    got = rules.rule_verdicts(spark.createDataFrame(rows, DOCS)).collect()
    kept = Counter(r.doc_id // 100 for r in got if r.kept)
    assert len(got) == len(rows) and kept == {0: 61, 2: 60, 3: 3}
    assert rules.rule_verdicts(spark.createDataFrame([], DOCS)).collect() == []


def test_fences_come_from_the_sketch(spark):
    """Groups whose median is 0 have fences of their own: what is far out in one is usual in another."""
    random.seed(6)

    def text(lines, copies):
        own = [" ".join(f"w{random.randint(0, 10 ** 9)}" for _ in range(9)) for _ in range(lines - copies)]
        return "\n".join(own + own[:copies])

    # Of one language nearly none has a repeated line, of the other every twelfth a quarter.
    rows = [(i, text(12, 0), "en", "a", "x") for i in range(600)]
    rows += [(1000 + i, text(12, 3 if i % 12 == 0 else 0), "de", "b", "x") for i in range(600)]
    rows += [(2000, text(12, 3), "en", "a", "x"), (2001, text(12, 3), "de", "b", "x")]
    rows += [(3000 + i, text(12, 2 if i < 25 else 0), "fr", "c", "x") for i in range(600)]
    got = {r.doc_id: r for r in rules.rule_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    fences = {(got[i].most_dup_lines, got[i].most_repeats) for i in (0, 1000, 3000)}
    assert len(fences) == 3
    assert not got[2000].kept and got[2001].kept
    assert sum(r.kept for r in got.values()) == len(rows) - 1
    # A group with too few documents for the quantile takes its language's sketch.
    few = [(4000 + i, text(12, 0), "de", "few", "x") for i in range(20)] + [(4100, text(12, 3), "de", "few", "")]
    got = {r.doc_id: r for r in rules.rule_verdicts(spark.createDataFrame(rows + few, DOCS)).collect()}
    assert got[4100].kept and got[4100].most_dup_lines == got[1000].most_dup_lines


def test_words_may_be_too_short_or_too_long(spark):
    random.seed(7)

    def text(low, high):
        return " ".join("".join(random.choices("abcdefgh", k=random.randint(low, high))) for _ in range(80))

    rows = [(i, text(4, 9), "en", "a", "") for i in range(100)]
    rows += [(200, text(1, 3), "en", "a", ""), (201, text(20, 30), "en", "a", "")]
    got = {r.doc_id: r.kept for r in rules.rule_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert [i for i, kept in got.items() if not kept] in ([200, 201], [201, 200])


def test_sketch_buckets_hold_their_values(spark):
    values = [*range(300), 10 ** 6, 10 ** 12]
    df = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", rules.bucket(F.col("v")).alias("edge"))
    for v, edge in df.collect():
        assert v <= edge <= v + v // 16


MIX = "doc_id long, text string, source string, copy string, rate string"


def test_copies_have_the_target_rates(spark):
    rows = [(i, "t", "big", "x", "y") for i in range(6000)]
    rows += [(10_000 + i, "t", "small", "x", "y") for i in range(600)]
    rows += [(20_000 + i, None, None, "x", "y") for i in range(50)]
    rows += [(30_000 + i, "", "unwanted", "x", "y") for i in range(50)]
    weights = spark.createDataFrame([("big", 2.0), ("small", 7.0), (None, 1.0)],
                                    "source string, weight double")
    df = spark.createDataFrame(rows, MIX).repartition(5)
    got = mixing.poisson_mix(df, weights, size=8000).cache()
    by = Counter(r.source for r in got.collect())
    for source, share in (("big", 1600), ("small", 5600), (None, 800)):
        assert abs(by[source] - share) < 5 * math.sqrt(share)
    assert by["unwanted"] == 0 and got.columns == ["doc_id", "text", "source", "rate", "copy",
                                                   "shuffle_key"]
    # Poisson: the variance of a document's copies is their mean, also for sums of several draws.
    copies = Counter(r.doc_id for r in got.collect() if r.source == "small")
    counts = [copies[10_000 + i] for i in range(600)]
    mean = sum(counts) / 600
    assert 0.75 < sum((c - mean) ** 2 for c in counts) / 600 / mean < 1.3
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, mixing.poisson_mix(
        df.repartition(2), weights, size=8000).collect()), key=str)


def test_mixing_odd_tables(spark):
    empty = spark.createDataFrame([], MIX)
    assert mixing.poisson_mix(empty).collect() == []
    rows = [(None, None, "a", "x", "y"), (1, "t", "a", "x", "y"), (1, "t", "a", "x", "y")]
    got = mixing.poisson_mix(spark.createDataFrame(rows, MIX), size=60).collect()
    assert len({r.copy for r in got if r.doc_id == 1}) * 2 == sum(r.doc_id == 1 for r in got)
    none = spark.createDataFrame([("b", 1.0)], "source string, weight double")
    assert mixing.poisson_mix(spark.createDataFrame(rows, MIX), none).collect() == []


PAGES = "page_id long, url string, html string, host long"
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"), ("allow", "org/fr/")]


def judged(spark, pages, given=RULES):
    df = spark.createDataFrame([(i, u, h, 1) for i, (u, h) in enumerate(pages)], PAGES)
    return {r.page_id: r for r in urls.url_verdicts(df, urls.rule_table(spark, given)).collect()}


def test_rules_and_parts_of_urls(spark):
    cases = [
        ("https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net", "example.net", "", None, "allow"),
        ("http://x.net/de", "x.net", "/de", "net/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://b.example.com/de/1", "b.example.com", "/de/1", "example.com/de/", "block"),
        ("HTTP://ORG/fr/", "org", "/fr/", "org/fr/", "allow"),
        ("x://h?/a://b/c", "h", "", None, "allow"),
        ("mailto:a@b.net", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
        ("http:///net/", "", "/net/", None, "allow")]
    got = judged(spark, [(c[0], None) for c in cases])
    for i, case in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == case[1:], case
    assert judged(spark, []) == {}


def test_distrust_spreads_to_those_that_link_to_blocked_hosts(spark):
    farm = '<a href="http://spam.net/1">x</a> <A HREF=\'//spam.net/2\'>y</A>'
    good = '<a href="https://fine.example.com/">x</a><a href="/local">z</a>'
    pages = [("http://spam.net/", ""), ("http://farm.com/1", farm), ("http://farm.com/2", farm),
             ("http://www.org/fr/1", good), ("http://fine.example.com/1", None),
             ("http://far.com/", '<a href="http://farm.com/">f</a>' + good),
             ("http://lone.com/", "no links " * 1000), ("http://lone.com/", "no links")]
    got = judged(spark, pages)
    assert [got[i].verdict for i in range(8)] == [
        "block", "block", "block", "allow", "allow", "block", "allow", "allow"]
    assert got[4].trust > got[6].trust and got[1].distrust > got[5].distrust > 0


def test_ranks_equal_a_plain_loop(spark):
    random.seed(11)
    hosts = [f"h{i}" for i in range(12)]
    links = {(a, b): random.randint(1, 5) for a in hosts for b in hosts if a != b and random.random() < .3}
    seed = {h: 1 / 3 if i < 3 else 0.0 for i, h in enumerate(hosts)}
    rank = dict(seed)
    total = Counter()
    for (a, _), n in links.items():
        total[a] += n
    for _ in range(400):
        rank = {h: 0.15 * seed[h] + 0.85 * sum(rank[a] * n / total[a] for (a, b), n in links.items()
                                               if b == h) for h in hosts}
    nodes = spark.createDataFrame([("k", *row) for row in seed.items()], "kind string, host string, seed double")
    edges = spark.createDataFrame([("k", a, b, n / total[a]) for (a, b), n in links.items()],
                                  "kind string, src string, dst string, share double")
    got = {r.host: r["rank"] for r in urls.spread(nodes, edges, 1e-9).collect()}
    assert got == pytest.approx(rank)


def chain(length):
    """Each host links to the next one, and the last to a blocked one; one host apart is trusted."""
    hosts = [f"h{i}.com" for i in range(length)] + ["bad.net"]
    pages = [(f"http://{a}/", f'<a href="http://{b}/">x</a>') for a, b in zip(hosts, hosts[1:], strict=False)]
    return [*pages, ("http://bad.net/", None), ("http://www.org/fr/1", None)]


def test_distrust_reaches_the_end_of_a_chain(spark):
    got = judged(spark, chain(16))
    assert [got[i].verdict for i in range(18)] == ["block"] * 17 + ["allow"]


def test_verdicts_of_a_long_chain_have_converged(spark):
    pages = chain(60)
    got = judged(spark, pages)
    # Trust starts alike at all hosts but the trusted one and runs down the chain, distrust runs up.
    trust = [0.5 / 62 * (1 - 0.85 ** (i + 1)) for i in range(60)]
    distrust = [0.15 * 0.85 ** (60 - i) for i in range(60)]
    assert [got[i].verdict for i in range(60)] == [
        "block" if d > t else "allow" for t, d in zip(trust, distrust, strict=True)]
    assert [got[i].distrust for i in range(60)] == pytest.approx(distrust, abs=1e-2 / 62)
    assert {got[i].verdict for i in range(60)} == {"allow", "block"}
