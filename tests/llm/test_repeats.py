"""Repeated passages against all windows compared as words."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tidewarden.llm import repeats
from tidewarden.llm.queries import repeat_digests

SCHEMA = "doc_id long, text string, lang string, rid int, spans string, d int"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window=50):
    first = {}
    for doc_id, text, *_ in rows:
        words = split(text)
        order = (doc_id is not None, doc_id or 0)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            first[key] = min(first.get(key, order), order)
    result = []
    for doc_id, text, *_ in rows:
        words = split(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < (doc_id is not None, doc_id or 0):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        result.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(result, key=str)


def found(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in repeat_digests(frame).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def words(chance, count, size=400):
    return [f"w{chance.randrange(size)}" for _ in range(count)]


def mixed_rows(seed, docs=60):
    """Own text around passages of 30 to 140 words that many share, some of them changed or cut."""
    chance = random.Random(seed)
    pool = [words(chance, chance.choice([30, 49, 50, 51, 80, 140])) for _ in range(6)]
    rows = []
    for doc_id in chance.sample(range(1000), docs):
        parts = []
        for _ in range(chance.randrange(4)):
            parts += words(chance, chance.randrange(60))
            passage = list(chance.choice(pool))
            if chance.random() < 0.3:
                passage[chance.randrange(len(passage))] = "changed"
            if chance.random() < 0.3:
                passage = passage[chance.randrange(20):]
            parts += passage
        rows.append((doc_id, chance.choice([" ", "\n", "\t\x0b"]).join(parts), "en", 1, "clash", 2))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_match_all_windows(spark, seed):
    rows = mixed_rows(seed)
    expected = plain(rows)
    assert sum(r[2] for r in expected) > 500
    assert found(spark, rows) == expected


def test_odd_rows(spark):
    chance = random.Random(4)
    a, b, c = (" ".join(words(chance, n)) for n in (50, 120, 3000))
    rows = [(t[0], t[1], "x", 0, "", 0) for t in [
        (1, a), (2, a), (3, a + " tail"), (3, "head " + a), (3, "head " + a), (4, b), (4, b), (5, c),
        (6, c[:9000]), (7, c[6000:] + " " + c[:3000]), (8, None), (9, ""), (10, " \n\t "), (None, b),
        (None, b + " more"), (11, b), (12, "same " * 9000), (13, "same " * 8000), (14, "same " * 49),
        (15, "x" * 200000 + " " + a), (-5, a), (16, " ".join(b.split()[:60] + a.split() + b.split()[60:])),
        (17, " ".join(a.split()) + " " + a.replace(" ", "\r\n")), (18, b.replace(" ", " "))]]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_small_shards_and_slices(spark, monkeypatch):
    """The driver deals a few words to a shard and to what streams by it."""
    monkeypatch.setattr(repeats, "SHARD", 300)
    monkeypatch.setattr(repeats, "SLICE", 100)
    monkeypatch.setattr(repeats, "BLOCK", 64)
    rows = mixed_rows(5, docs=80)
    assert found(spark, rows) == plain(rows)


def test_spans_and_kept_words(spark):
    chance = random.Random(6)
    passage = words(chance, 55)
    rows = [(1, " ".join(passage), "", 0, "", 0),
            (2, " ".join(["a", "b", *passage, "c", *passage]), "", 0, "", 0)]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].spans == [] and got[1].kept == " ".join(passage)
    assert [tuple(s) for s in got[2].spans] == [(2, 57), (58, 113)]
    assert (got[2].kept, got[2].n_removed) == ("a b c", 110)


def test_automaton_matches_search():
    chance = random.Random(7)
    for _ in range(60):
        passages = [chance.choices([b"a", b"b", b"c"], k=chance.randrange(1, 30)) for _ in range(5)]
        automaton = repeats.Automaton()
        for document, passage in enumerate(passages):
            automaton.add(passage, document)
        text = chance.choices([b"a", b"b", b"c", b"d"], k=60)
        for document in (1, 3, 9):
            gone = set()
            for i in range(len(text) - 3):
                if any(passages[k][j:j + 4] == text[i:i + 4] for k in range(min(document, 5))
                       for j in range(len(passages[k]))):
                    gone.update(range(i, i + 4))
            spans = automaton.spans(text, document, 4)
            assert {p for lo, hi in spans for p in range(lo, hi)} == gone
