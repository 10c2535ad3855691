from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.llm import quality as q

SF = "/root/testdata/sf0.01"


def blobs(n, shift, seed):
    return np.random.default_rng(seed).normal(shift, 1, (n, 4)).astype(np.float32)


def test_prior_and_risk_on_mixed_blobs():
    positives = blobs(3000, 2, 1)
    unlabelled = np.vstack([blobs(2100, 2, 2), blobs(900, -2, 3)])
    one = q._one
    assert q.class_prior(one(positives), one(unlabelled)) == pytest.approx(0.7, abs=0.06)
    model = q.fit(positives, unlabelled)
    good, bad = model.scores(blobs(500, 2, 4)), model.scores(blobs(500, -2, 5))
    assert (good >= 0.7).mean() > 0.97 and (bad < 0.3).mean() > 0.97


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(200).select(F.col("id").alias("doc_id"), q.held_out("doc_id").alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.collect())


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = q.train(docs, labels)
    return docs, labels, model, q.score(docs, model).cache()


def test_held_out_accuracy(judged):
    _, labels, _, scored = judged
    rows = scored.join(labels, "doc_id").filter(q.held_out("doc_id")).collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    wins = np.mean([g > b for g in good for b in bad])
    assert len(good) > 50 and len(bad) > 10 and wins > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_are_not_read(spark, judged):
    docs, labels, model, _ = judged
    turned = labels.withColumn("quality", F.when(q.held_out("doc_id"), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    assert np.array_equal(q.train(docs, turned).weights, model.weights)


def test_scores_depend_on_the_text_alone(spark, judged):
    docs, _, model, scored = judged
    moved = docs.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("xx"))
    again = {r.doc_id - 7: r.score for r in q.score(moved, model).collect()}
    assert again == {r.doc_id: r.score for r in scored.collect()}


def test_odd_rows(spark, judged):
    model = judged[2]
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, " \n ", None), (3, "x" * 200_000, "c"),
            (4, "\x00 ½ 日本", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = q.score(df, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert q.score(df.limit(0), model).collect() == []


def test_without_labels_there_is_no_model(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(9)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.train(docs, none)
    assert {r.score for r in q.score(docs, model).collect()} == {0.5}


def test_contradicting_and_null_labels_are_not_trusted(spark):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(40)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1)], "doc_id long, quality int")
    assert q.train(docs, labels).prior == 0.5


def plain_risk(w, p, u, prior):
    """The non-negative unbiased risk of linear coefficients, written out."""
    def loss(z):
        return np.log1p(np.exp(-z))

    of_negatives = np.mean([loss(-z) for z in u @ w]) - prior * np.mean([loss(-z) for z in p @ w])
    return prior * np.mean([loss(z) for z in p @ w]) + max(0.0, of_negatives)


def test_fit_has_the_least_risk():
    """No coefficients near the fitted ones, nor a plain search from zero, do better."""
    chance = np.random.default_rng(8)
    positives, unlabelled = blobs(400, 1, 5), np.vstack([blobs(200, 1, 6), blobs(200, -1, 7)])
    model = q.fit(positives, unlabelled, prior=0.5, rounds=1500)
    p, u = (q._one(model.scaled(rows)).astype(float) for rows in (positives, unlabelled))

    def goal(w):
        return plain_risk(w, p, u, 0.5) + q.DECAY / 2 * (w[:-1] ** 2).sum()

    best = np.append(model.weights, model.bias).astype(float)
    assert all(goal(best) <= goal(best + chance.normal(0, s, 5)) + 1e-4
               for s in (0.01, 0.1, 1.0) for _ in range(100))
    w = np.zeros(5)
    for _ in range(3000):
        step = w + chance.normal(0, 0.1, 5)
        w = step if goal(step) < goal(w) else w
    assert goal(best) <= goal(w) + 1e-3


def test_scores_are_those_of_the_written_out_model(judged):
    docs, _, model, scored = judged
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in scored.limit(50).collect():
        z = sum(float(w) * min(max((float(x) - float(c)) / float(s), -8), 8) for w, x, c, s in zip(
            model.weights, q.features(texts[r.doc_id]), model.centre, model.scale, strict=True)) + model.bias
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


@pytest.mark.parametrize("sample", [100, q.SAMPLE])
def test_repeated_rows_change_nothing(spark, judged, sample):
    docs, labels, _, _ = judged
    once = q.train(docs, labels, sample)
    for times in (2, 6):
        again = q.train(docs.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times)))), labels, sample)
        assert again.prior == pytest.approx(once.prior) and np.array_equal(again.weights, once.weights)


def test_all_documents_labelled(spark, judged):
    docs, labels, model, _ = judged
    told = docs.join(labels, "doc_id", "left").select(
        "doc_id", F.coalesce("quality", F.expr("doc_id % 3 > 0").cast("int")).alias("quality"))
    full = q.train(docs, told)
    scored = q.score(docs, full).join(labels, "doc_id").collect()
    assert 0.02 < full.prior < 0.98
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.9


def test_prior_counts_all_documents(spark):
    """The share above each cut, against one model applied in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).cache()
    chance = np.random.default_rng(3)
    model = q._blank()
    w = chance.normal(0, 1, q.FEATURES + 1).astype(np.float32)
    z = np.array([float(q._one(model.scaled(q.features(r.text or "")[None])) @ w) for r in docs.collect()])
    cuts = np.sort(z[::7]) + 1e-4
    below, total = q._below(docs, model, w, cuts)
    assert total == 300 and np.abs(below - np.searchsorted(np.sort(z), cuts)).max() <= 1
