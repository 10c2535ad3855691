from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewarden.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "Hello world", "  two  spaces \n\n\ttabs ", "don't we'll 3rd ½ ½½", "日本語 text", "é" * 50,
         "naïve façade — “quoted”", "a<|endoftext|>b", "  x", "🙂 emoji 👍🏽", "x" * 3000,
         "\x00\x1c\x85 odd", "Ǆ Ɐ ɏ ɐ", "١٢٣ 123 ²"]


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_library(exact, text):
    assert packing.tokeniser(PATH)(text) == exact.encode(text, add_special_tokens=False).ids


def test_ids_of_random_texts(exact):
    random.seed(2)
    for _ in range(300):
        text = "".join(random.choices("ab cdE'stéß \n\t\r12.,!?-_$½  ", k=60))
        assert packing.tokeniser(PATH)(text) == exact.encode(text, add_special_tokens=False).ids


def test_spread_of_pieces_is_whole_and_nearly_even():
    random.seed(3)
    sizes = [random.randint(1, 256) for _ in range(900)]
    places = packing.spread_evenly(sizes, 110)
    assert sorted(i for p in places for i in p) == list(range(900))
    sums = [sum(sizes[i] for i in p) for p in places]
    assert max(sums) - min(sums) <= 8
    assert packing.spread_evenly([5], 1) == [[0]] and packing.spread_evenly([], 1) == []


def test_differencing_of_two_windows_by_hand():
    # 8-7, 6-5 and 4 difference to 1, 1, 4, then 4-1 = 3, then 3-1 = 2.
    places = packing.spread_evenly([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in places) == [14, 16]


def test_windows_rise_over_capacity():
    sizes = [700] * 3
    assert len(packing.windows_of(sizes)) == 3
    assert all(len(p) == 1 for p in packing.windows_of(sizes))


def test_pieces_rebuild_every_document(spark, exact):
    random.seed(4)
    texts = [*TEXTS, None, *(" ".join(random.choices(["alpha", "be", "gamma's", "42"],
                                                     k=random.randint(1, 3000))) for _ in range(60))]
    rows = [(i if i % 9 else None if i == 9 else i, t, "x") for i, t in enumerate(texts)]
    rows += [(5, texts[5], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    pieces = packing.pack(df, PATH, pool_windows=8).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length > 0
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.WINDOW
    for key, text, _ in rows:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [0]
        got = sorted(by_doc[key], key=lambda p: p.start)
        if key == 5:
            # A repeated row is packed twice.
            assert sum(p.length for p in got) == 2 * len(ids)
            continue
        assert b"".join(p.ids for p in got) == np.array(ids, "<u4").tobytes()
        assert {p.doc_tokens for p in got} == {len(ids)}
    full = sum(p.length for p in pieces)
    assert full / (packing.WINDOW * len(by_sequence)) > 0.9


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, PATH).collect() == []


def test_query_digests_pieces(spark):
    from tidewarden.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    encode = packing.tokeniser(PATH)
    tokens = {key: np.array(encode(t or "") + [0], "<u4") for key, t in docs.items()}
    rows = QUERIES["op6_differencing_pack"](spark, sf).collect()
    assert sum(r.length for r in rows) == sum(map(len, tokens.values()))
    for r in rows:
        part = tokens[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(tokens[r.doc_id])


def dense_differencing(sizes, windows):
    """Multiway differencing with all windows of a partition written out, zeros too."""
    parts = [(size, i, [(size, [i])] + [(0, [])] * (windows - 1)) for i, size in enumerate(sizes)]
    turn = len(sizes)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-p[0], p[1]))
        a, b = parts[0][2], parts[1][2]
        both = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, b[::-1], strict=True)),
                      key=lambda w: -w[0])
        parts[:2] = [(both[0][0] - both[-1][0], turn, both)]
        turn += 1
    return sorted(total for total, _ in parts[0][2]) if parts else []


def test_differencing_equals_the_written_out_one():
    chance = random.Random(12)
    for _ in range(150):
        sizes = [chance.randint(1, 60) for _ in range(chance.randint(1, 40))]
        windows = chance.randint(1, 12)
        found = packing.spread_evenly(sizes, windows)
        assert sorted(i for places in found for i in places) == list(range(len(sizes)))
        sums = sorted([sum(sizes[i] for i in places) for places in found] + [0] * (windows - len(found)))
        assert sums == dense_differencing(sizes, windows)


def test_a_pool_of_tiny_texts_stays_small():
    import tracemalloc

    tracemalloc.start()
    filled = packing.windows_of([1] * packing.POOL_PIECES)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(filled) == 64 and all(len(places) == 1024 for places in filled)
    assert peak < 100e6
