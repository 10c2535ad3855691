"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from tidewarden.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, id string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def plain(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[word] = best if best and counts[best] >= 2 * counts[word] else None

    def root(word):
        return root(forms[word]) if forms[word] else word

    return {w: (forms[w], root(w), n, len(near[w]), counts.get(forms[w])) for w, n in counts.items()}


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = spelling.spelling_groups(frame).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def misspelt(chance, word, letters):
    at = chance.randrange(len(word))
    return chance.choice([word[:at] + word[at + 1:], word[:at] + chance.choice(letters) + word[at:],
                          word[:at] + chance.choice(letters) + word[at + 1:]])


def noisy_rows(seed, letters, stems, docs):
    chance = random.Random(seed)
    words = ["".join(chance.choices(letters, k=chance.randrange(4, 9))) for _ in range(stems)]
    words += [misspelt(chance, w, letters) for w in words for _ in range(4)]
    words += [misspelt(chance, w, letters) for w in words if chance.random() < 0.3]
    return [(i, " ".join(chance.choices(words, weights=range(len(words), 0, -1), k=300)), "x", 1, "y")
            for i in range(docs)]


@pytest.mark.parametrize("seed, letters, stems, docs", [
    (1, "abcdefghijklmnopqrstuvwxyz", 60, 12), (2, "abé", 40, 12), (3, "ab", 30, 20),
    (4, "aÀÿ×", 30, 20), (5, "abcdefgh", 500, 40)])
def test_groups_match_all_pairs(spark, seed, letters, stems, docs):
    rows = noisy_rows(seed, letters, stems, docs)
    expected = plain(rows)
    assert any(e[0] for e in expected.values())
    assert found(spark, rows) == expected


def test_odd_rows(spark):
    rows = [(None, "Tyme Tymes tymes TYMES tymes x tyme's tymes", "", 0, ""), (1, None, "", 0, ""),
            (2, "", "", 0, ""), (2, "tymesx tymesx tymesx", "", 0, ""),
            *[(3, "b" * 30000 + " " + "b" * 29999 + " " + "a" * 50 + "c" * 50, "", 0, "")] * 3,
            (4, "Élan élan Élans Élans Élans Élann Élann Élann " * 3, "", 0, ""),
            (5, "naïve,naïve;naïve naive naive naive " * 4 + "naïv naïv naïv", "", 0, "")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == {}


def test_forms_chain_to_a_root(spark):
    rows = [(1002 + i, "abcde " * 40 + "abcdef " * 20 + "abcdefg " * 8 + "abcdefgh " * 3, "", 0, "")
            for i in range(3)]
    got = found(spark, rows)
    assert got == plain(rows)
    assert got["abcdefgh"][:2] == ("abcdefg", "abcde")


def test_pivots_are_the_cheapest_disjoint_pair():
    chance = random.Random(5)
    for _ in range(300):
        word = "".join(chance.choices("abc", k=chance.randrange(5, 12)))
        counts = {a + b: chance.randrange(1, 20) for a in "abc" for b in "abc"}
        prefix = spelling.grams_of(word, counts)
        pairs = [p for p in combinations(prefix, 2) if abs(p[0][2] - p[1][2]) >= 2]
        got = spelling.pivots_of(prefix)
        assert len(got) == 2 and abs(got[0][2] - got[1][2]) >= 2
        assert sum(g[0] for g in got) == min(a[0] + b[0] for a, b in pairs)
