from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewarden.llm import warc

SCHEMA = "page_id long, url string, html string, row string"
INNER = (warc.VERSION + "WARC-Type: response\r\nX-Page-ID: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows():
    found = [(1, "http://a/x y\r\nEvil: 1", "<p>é</p>"), (2, None, None), (3, "u", ""),
             (4, "http://b", INNER * 3), (5, "z", warc.VERSION * 40 + "tail\r\n\r\n"),
             (6, "z", "WARC/1.1\r"), (7, "q", warc.VERSION), (8, "h", "<p>é</p>"),
             (8, "h", "<p>é</p>"), (None, "n", "<p>é</p>"), (11, None, "x" * 9000 + warc.VERSION
                                                             + "y" * 7000 + INNER + "\r\n\r\n")]
    return [(*r, "clash") for r in [*found, *((i, f"h{i}", f"body {i} " * (i % 50))
                                              for i in range(20, 70))]]


def test_round_trip_with_records_inside_payloads(spark, small_splits):
    given = rows()
    got = warc.round_trip(spark.createDataFrame(given, SCHEMA).repartition(3)).collect()
    assert len(got) == len(given)
    html = {(None if p is None else str(p)): h or "" for p, _, h, _ in given}
    for r in got:
        assert r.payload_bytes == len(html[r.page].encode())
        assert r.payload_digest == digest(html[r.page])
    revisits = sorted((r.page or "", r.refers_to) for r in got if r.record_type == "revisit")
    assert revisits == [("", "1"), ("3", "2"), ("50", "2"), ("8", "1"), ("8", "1")]
    names = [r.page for r in got if r.record_type == "response"]
    assert len(names) == len(set(names))
    uris = {r.page: r.uri for r in got}
    assert uris["1"] == "http://a/x%20y%20%20Evil:%201" and uris["2"] is None


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "a", "ab", ""), (2, "b", "ab", ""), (3, "c", "abcd", ""),
                                (4, "d", "abcd", "")], SCHEMA)
    got = {r.page: (r.record_type, r.refers_to) for r in warc.round_trip(df, 3).collect()}
    assert got == {"1": ("response", None), "2": ("response", None), "3": ("response", None),
                   "4": ("revisit", "3")}


def test_a_page_that_is_repeated_whole(spark):
    df = spark.createDataFrame([(1, "a", "x", "")] * 3 + [(None, None, None, "")] * 2, SCHEMA)
    got = sorted(((r.page or "", r.record_type, r.refers_to) for r in warc.round_trip(df).collect()),
                 key=str)
    assert got == [("", "response", None), ("", "revisit", None), ("1", "response", None),
                   ("1", "revisit", "1"), ("1", "revisit", "1")]


def test_only_chains_from_the_start_are_records(spark):
    links = [("f", 10, 50), ("f", 20, 50), ("f", 30, 40), ("f", 50, 90), ("f", 90, 400),
             ("g", 12, 50), ("g", 50, 60)]
    df = spark.createDataFrame(links, "file string, at long, to long")
    assert sorted(map(tuple, warc.reachable(df).collect())) == [("f", 10), ("f", 50), ("f", 90)]
    chain = spark.range(200).select(F.lit("c").alias("file"), (F.col("id") * 7 + 10).alias("at"),
                                    (F.col("id") * 7 + 17).alias("to"))
    assert warc.reachable(chain).count() == 200


def test_header_of_other_text_is_none():
    assert warc.parse_headers(b"no header") is None
    assert warc.parse_headers(b"bad line\r\n\r\n") is None
    assert warc.parse_headers(b"Content-Length: x\r\n\r\n") is None
    assert warc.parse_headers(b"A-b:  c\r\nContent-Length: 3\r\n\r\nxyz")[1] == 30


def test_base32_digest(spark):
    texts = ["", "a", "é" * 99]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(warc.base32_sha1(F.col("t").cast("binary")).alias("d")).collect()
    assert [r.d for r in got] == [digest(t) for t in texts]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_records_are_dated_and_ids_are_one_line(spark):
    df = spark.createDataFrame([("a\r\nWARC-Type: evil", "u", "x", ""), ("b", "u", "x", "")],
                               "page_id string, url string, html string, row string")
    values = [r.value for r in warc.records(df, date="2024-05-06 07:08:09").collect()]
    assert all("\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n" in v for v in values)
    got = {r.page: (r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    assert got == {"a%20%20WARC-Type: evil": ("response", None),
                   "b": ("revisit", "a%20%20WARC-Type: evil")}
    now = warc.records(df).first().value
    assert warc.parse_headers(now.removeprefix(warc.VERSION).encode())[0]["warc-date"].endswith("Z")


def test_chains_are_not_broadcast(spark):
    links = spark.range(50).select(F.lit(1).alias("file"), (F.col("id") * 7 + 10).alias("at"),
                                   (F.col("id") * 7 + 17).alias("to"))
    plan = warc._merged(links, links.select("file", "at"), ["file", "at"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("region", [1, 10, 64, 1 << 20])
def test_regions_of_any_size_keep_the_same_records(spark, monkeypatch, region):
    """Random links, most of them forward, some to nowhere, back or to themselves."""
    monkeypatch.setattr(warc, "REGION", region)
    chance = random.Random(region)
    links = []
    for file in ("a", "b", "c"):
        places = sorted({10, *chance.sample(range(11, 900), 120)})
        for i, at in enumerate(places):
            to = chance.choice([*places[i + 1:i + 6], at + 1000 if chance.random() < 0.1 else at + 3]) \
                if chance.random() < 0.97 else chance.choice([at, 10, at + 1])
            links.append((file, at, to))
    onward = {(f, a): t for f, a, t in links}
    expected = set()
    for file in ("a", "b", "c"):
        at = 10
        while (file, at) in onward and (file, at) not in expected:
            expected.add((file, at))
            to = onward[file, at]
            at = to if to > at else None
    df = spark.createDataFrame(links, "file string, at long, to long").repartition(3)
    got = [tuple(r) for r in warc.reachable(df).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
