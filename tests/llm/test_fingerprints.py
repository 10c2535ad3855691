from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidewarden.llm import fingerprints as fp


def plain_winnow(text, k, window):
    """Each window by itself, from the same hashes."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    hashes = fp.rolling_hashes(codes, k)
    width = max(1, min(window, len(hashes) // fp.SHORT))
    places = set()
    for i in range(len(hashes) - width + 1):
        part = hashes[i:i + width].tolist()
        places.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return [(int(hashes[p]), p) for p in sorted(places)]


def plain_likeness(a, b):
    """Of what windows of one size choose in both texts: the size of the shorter text's windows."""
    def chosen(text, width):
        if not text:
            return set()
        hashes = fp.rolling_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), fp.K).tolist()
        return {min(hashes[i:i + width]) for i in range(max(len(hashes) - width, 0) + 1)}

    width = max(1, min(fp.WINDOW, *(max(len(t) - fp.K + 1, 1) // fp.SHORT for t in (a, b))))
    a, b = chosen(a, width), chosen(b, width)
    return len(a & b) / len(a | b) if a | b else 1


def texts():
    random.seed(5)
    words = ["".join(random.choice("abcdé ") for _ in range(n)) for n in (1, 5, 11, 12, 13, 40, 700)]
    return ["", "a", "aaaa" * 80, "ab" * 300, "x" * 5000, *words]


@pytest.mark.parametrize("block", [1 << 20, 37])
@pytest.mark.parametrize("text", texts())
def test_winnowing_is_the_rightmost_minimum_of_each_window(monkeypatch, text, block):
    monkeypatch.setattr(fp, "BLOCK", block)
    hashes, places = fp.winnow(text)
    assert list(zip(hashes.tolist(), places.tolist())) == plain_winnow(text, fp.K, fp.WINDOW)


def test_rolling_hash_is_of_the_characters_alone():
    codes = np.frombuffer("abcabcabc".encode("utf-32-le"), "<u4")
    hashes = fp.rolling_hashes(codes, 3)
    assert hashes[0] == hashes[3] == hashes[6] and len(set(hashes.tolist())) == 3
    assert int(hashes.max()) < 1 << 40


def test_a_shared_passage_of_the_guaranteed_length_is_found():
    random.seed(7)
    letters = "abcdefghijklmnopqrstuvwxyz "
    for _ in range(50):
        shared = "".join(random.choices(letters, k=fp.WINDOW + fp.K - 1))
        a, b = ("".join(random.choices(letters, k=random.randint(0, 2000))) + shared
                + "".join(random.choices(letters, k=random.randint(0, 2000))) for _ in range(2))
        assert len(np.intersect1d(fp.winnow(a)[0], fp.winnow(b)[0]))


def test_the_string_keeps_hashes_and_places():
    text = "the quick brown fox jumps over the lazy dog " * 30
    hashes, places = fp.winnow(text)
    string, at = fp.as_string(hashes, places), 0
    for i, (h, p) in enumerate(zip(hashes.tolist(), places.tolist())):
        part = string[12 * i:12 * i + 12]
        at += int(part[10:], 16)
        assert (int(part[:10], 16), at) == (h, p)
    assert len(string) == 12 * len(hashes)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_edited_texts_against_a_plain_loop(spark, parts):
    random.seed(1)
    rows = [(i, "".join(random.choices("abc dé", k=random.choice([0, 1, 9, 60, 400]))), i)
            for i in random.sample(range(1000), 60)]
    rows += [(500, None, 1), (7, "x" * 30_000, 2)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "doc_id long, text string, run int").repartition(5)
    got = {r.doc_id: r for r in fp.edited_likeness(df, parts=parts).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert set(got) == {r[0] for r in rows}
    for this, following in zip(order, order[1:] + order[:1]):
        text, other = this[1] or "", following[1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        r = got[this[0]]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fp.as_string(*fp.winnow(text))
        assert r.edited_fingerprint == fp.as_string(*fp.winnow(edited))
        assert r.near_edited == pytest.approx(plain_likeness(text, edited))
        assert r.near_next == pytest.approx(plain_likeness(text, other))


def test_a_text_inside_a_longer_one_is_sampled_alike():
    """All of the short text's hashes lie in the long one; windows of two sizes would miss most."""
    random.seed(3)
    short = "".join(random.choices("abcdefghijklmnop ", k=100))
    long = "".join(random.choices("abcdefghijklmnop ", k=400)) + short
    found = [fp.winnow(t)[0] for t in (short, long)]
    assert fp.text_likeness(short, long, *found) == fp.text_likeness(long, short, *found[::-1])
    assert fp.text_likeness(short, long, *found) == pytest.approx(plain_likeness(short, long))
    assert fp.text_likeness(short, short, found[0], found[0]) == 1


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fp.edited_likeness(empty).collect() == []
    assert fp.fingerprints(empty).collect() == []
    one = spark.createDataFrame([(3, "alone in here, quite alone")], "doc_id long, text string")
    assert fp.edited_likeness(one).first().near_next == 1
    odd = spark.createDataFrame([(None, "a b"), (None, None), (1, "same"), (1, "same")],
                                "doc_id long, text string")
    assert fp.edited_likeness(odd).count() == 4
    prints = [r.fingerprint for r in fp.fingerprints(odd).filter("doc_id = 1").collect()]
    assert len(prints) == 2 and len(set(prints)) == 1
