"""Each stage on its own input, by plain means; the whole by its parts."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from test_jaccard import plain_classes
from tidewarden.llm import packing, pii
from tidewarden.llm.common import written
from tidewarden.llm.queries import tokeniser_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SF), "stage"))
    return [t.collect() for t in tables], [t.columns for t in tables]


def test_columns_and_names(staged):
    assert all(columns == COLUMNS for columns in staged[1][:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram jaccard join", "pii", "mixing sources", "packing"]


def test_labelled_documents_are_kept_by_quality(spark, staged):
    before, after = staged[0][0], {r.doc_id for r in staged[0][1]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [(r.doc_id in after) == labels[r.doc_id] for r in before if r.doc_id in labels]
    assert np.mean(right) > 0.95


def test_one_document_of_each_class(staged):
    before, after = staged[0][1], staged[0][2]
    classes = {c for _, c, _ in plain_classes([(r.doc_id, r.text) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(classes)


def test_personal_data_is_gone_and_the_rest_is_whole(staged):
    before, after = ({r.doc_id: r for r in staged[0][i]} for i in (2, 3))
    assert before.keys() == after.keys()
    changed = 0
    for key, r in after.items():
        old = before[key]
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        if not pii.spans_of(old.text):
            assert r.text == old.text
        else:
            changed += r.text != old.text
    assert changed


def test_copies_are_of_kept_documents(staged):
    before, after = {r.doc_id: r for r in staged[0][3]}, staged[0][4]
    counts = Counter(r.doc_id for r in after)
    assert counts.keys() <= before.keys() and max(counts.values()) > 1
    assert all(r == before[r.doc_id] for r in after)
    assert 0.6 < len(after) / len(before) < 1.5


def test_pieces_hold_every_copy(staged):
    encode = packing.tokeniser(tokeniser_path())
    tokens = {r.doc_id: np.array(encode(r.text or "") + [0], "<u4") for r in staged[0][4]}
    copies = Counter(r.doc_id for r in staged[0][4])
    lengths = Counter()
    for p in staged[0][5]:
        part = tokens[p.doc_id][p.start:p.start + p.length].tobytes()
        assert bytes(p.ids) == part and p.ids_crc32 == zlib.crc32(part)
        lengths[p.doc_id] += p.length
    assert lengths == Counter({key: n * len(tokens[key]) for key, n in copies.items()})


def test_run_is_the_stages_in_a_row(spark, staged):
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()
    assert Counter(map(tuple, rows)) == Counter(
        (p.doc_id, p.start, p.length, p.ids_crc32) for p in staged[0][5])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "empty")
        assert docs.count() == 0


CLASHES = "score double, predicted string, copy int, shuffle_key string, class_id string, spans int"


def test_odd_documents_keep_their_own_columns(spark):
    """Null, empty, long and repeated texts, with columns named like those of the operators."""
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    odd = [(None, None, None, None, None), (10_001, "", "en", None, 0), (10_002, None, "en", "s", None),
           (10_003, "plain words go on " * 60_000, "en", "s", 1_080_000),
           *[(10_004, "the same row again, " * 30, "en", "s", 600)] * 3]
    rows = [(*r, 0.1, "p", 3, f"k{i}", "c", i) for i, r in enumerate([*map(tuple, given), *odd])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")
    own = Counter((r[0], *r[5:]) for r in rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "odd")
        assert docs.columns == [*COLUMNS, *[c.split()[0] for c in CLASHES.split(", ")]]
        now = Counter((r[0], *r[5:]) for r in docs.collect())
        assert now.keys() <= own.keys(), name
        if name in ("pii",):
            assert now == before
        before = now
    tokens = corpus_pipeline.pack_sequences(spark, docs, SF).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in tokens} == {key[0] for key in before}
