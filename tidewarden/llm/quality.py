"""Quality classifier from trusted positives and unlabelled text (positive-unlabelled learning).

A linear model over shares of character classes, of pairs of neighbouring classes, and of repeated
words and lines is fitted to trusted positives and unlabelled texts alone: it minimises the
non-negative unbiased risk  prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-))  with the logistic
loss; while the second part is negative, its gradient is turned round. The class prior is estimated
first: of a model that tells positives from unlabelled texts, the least ratio of the unlabelled to
the positive share above a cut. Texts are halved by their hash, so copies stay together: that model is
fitted to one half, and the shares are those of the other half, of the sampled positives and of all
documents, counted in Spark.

The unlabelled texts are documents of all kinds, labelled ones too, with their labels unread. The model
is fitted on the driver to at most ``SAMPLE`` trusted and ``SAMPLE`` unlabelled texts, those with the
smallest hashed ids; every text is scored, whole. Text is the only input of a score.

A null text is empty; empty texts have a score like all others. Labels that are null, or that
contradict each other for one id, are not trusted. Repeated rows get a row and the same score each; of
an id's texts the first in order is learned from.
Without trusted or unlabelled texts there is no model, and every score is the prior, 0.5. An empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.llm.common import ship_package

#: Most trusted and most unlabelled texts that the model is fitted to.
SAMPLE = 10_000
ROUNDS = 300
#: Weight of the squared coefficients.
DECAY = 1e-3

# Classes of bytes: each listed character's own, the others by kind.
_OWN = "!|*$%&#"
_MARKS = ".,;:?'\"-()"
CLASSES = 8 + len(_OWN) + 2


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 6, np.uint8)  # other ASCII
    kinds[ord("a"):ord("z") + 1] = 0
    kinds[ord("A"):ord("Z") + 1] = 1
    kinds[ord("0"):ord("9") + 1] = 2
    kinds[ord(" ")] = 3
    kinds[ord("\n")] = 4
    for mark in _MARKS:
        kinds[ord(mark)] = 5
    kinds[128:] = 7
    for i, mark in enumerate(_OWN):
        kinds[ord(mark)] = 8 + i
    kinds[ord("<")] = kinds[ord(">")] = 8 + len(_OWN)
    return kinds


_KINDS = _byte_classes()
FEATURES = CLASSES + CLASSES * CLASSES + 6


def features(text: str) -> np.ndarray:
    """Square roots of shares, so that a little of something counts."""
    out = np.zeros(FEATURES, np.float32)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return out
    kinds = _KINDS[raw]
    out[:CLASSES] = np.bincount(kinds, minlength=CLASSES) / len(kinds)
    if len(kinds) > 1:
        pairs = kinds[:-1].astype(np.int16) * CLASSES + kinds[1:]
        out[CLASSES:CLASSES + CLASSES * CLASSES] = np.bincount(
            pairs, minlength=CLASSES * CLASSES) / len(pairs)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    count = max(len(words), 1)
    out[-6:] = (1 - len(set(words)) / count, sum(map(eq, words, words[1:])) / count,
                1 - len(set(lines)) / max(len(lines), 1), len(lines) / count,
                min(sum(map(len, words)) / count / 20, 1), min(np.log1p(count) / 20, 1) ** 2)
    return np.sqrt(np.maximum(out, 0))


@dataclass
class Model:
    prior: float
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.scale, -8, 8)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scaled(rows) @ self.weights + self.bias, -30, 30)))


def _blank() -> Model:
    return Model(0.5, np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32),
                 np.zeros(FEATURES, np.float32), 0.0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(size: int, gradient, rounds: int) -> np.ndarray:
    """Adam, whole batches; the last coefficient is the bias and isn't shrunk."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        g = gradient(w.astype(np.float32)).astype(np.float64)
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w.astype(np.float32)


def _one(rows: np.ndarray) -> np.ndarray:
    return np.hstack([rows, np.ones((len(rows), 1), rows.dtype)])


def telling(p: np.ndarray, u: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Coefficients that tell positives from unlabelled rows."""
    def gradient(w: np.ndarray) -> np.ndarray:
        return (p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u)) / 2

    return _descend(p.shape[1], gradient, rounds)


def cuts_of(of_p: np.ndarray) -> np.ndarray:
    """Cuts that leave enough of the positives above them, in order."""
    return np.sort(of_p)[: max(1, int(0.9 * len(of_p)))]


def least_ratio(of_p: np.ndarray, cuts: np.ndarray, below: np.ndarray, total: int) -> float:
    """The least share ratio above a cut; ``below`` are the unlabelled rows before each cut."""
    above_p = 1 - np.searchsorted(np.sort(of_p), cuts) / len(of_p)
    above_u = 1 - below / total
    # The slack is that of both shares.
    slack = np.sqrt(np.log(20) / 2 / len(of_p)) + np.sqrt(np.log(20) / 2 / total)
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def class_prior(positives: np.ndarray, unlabelled: np.ndarray, rounds: int = ROUNDS) -> float:
    """The share of positives among the unlabelled: fitted on the even rows, read off the odd."""
    p, u, p_test, u_test = positives[::2], unlabelled[::2], positives[1::2], unlabelled[1::2]
    if not (len(p_test) and len(u_test)):
        return 0.5
    w = telling(p, u, rounds)
    cuts = cuts_of(p_test @ w)
    return least_ratio(p_test @ w, cuts, np.searchsorted(np.sort(u_test @ w), cuts), len(u_test))


def scaling(positives: np.ndarray, unlabelled: np.ndarray) -> Model:
    """A model without weights that knows centre and scale of its features."""
    model, pooled = _blank(), np.vstack([positives, unlabelled])
    model.centre, model.scale = pooled.mean(0), pooled.std(0) + 1e-3
    return model


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None = None,
        rounds: int = ROUNDS) -> Model:
    """The model of the least non-negative risk; rows are features of texts."""
    if not (len(positives) and len(unlabelled)):
        return _blank()
    model = scaling(positives, unlabelled)
    p, u = _one(model.scaled(positives)), _one(model.scaled(unlabelled))
    model.prior = prior = class_prior(p, u, rounds) if prior is None else prior

    def gradient(w: np.ndarray) -> np.ndarray:
        at_p, at_u = _sigmoid(p @ w), _sigmoid(u @ w)
        as_positive = prior * (p.T @ (at_p - 1)) / len(p)
        as_negative = u.T @ at_u / len(u) - prior * (p.T @ at_p) / len(p)
        risk = np.logaddexp(0, np.clip(u @ w, -30, 30)).mean() \
            - prior * np.logaddexp(0, np.clip(p @ w, -30, 30)).mean()
        return as_positive + as_negative if risk >= 0 else -as_negative

    w = _descend(p.shape[1], gradient, rounds)
    model.weights, model.bias = w[:-1].astype(np.float32), float(w[-1])
    return model


def held_out(doc_id: str) -> Column:
    """The fold that labels are never learned from: CRC-32 of the id as text, remainder 2 of 4."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _features_of(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` (not null) and the features of ``text`` as bytes."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t or "").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(rows, pa.binary())], names=[*keep, "features"])

    ship_package(docs.sparkSession)
    kinds = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in keep)
    return docs.select("text", *keep).mapInArrow(of, f"{kinds}, features binary")


def _below(docs: DataFrame, model: Model, w: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of the documents' texts lie before each cut, and how many there are."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.stack([features(t or "") for t in batch.column(0).to_pylist()])
            at = np.searchsorted(cuts, _one(model.scaled(rows)) @ w, "right")
            places, n = np.unique(at, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(n, pa.int64())],
                                             names=["at", "n"])

    counted = docs.select("text").mapInArrow(of, "at long, n long").groupBy("at").agg(F.sum("n"))
    # A row for each cut at most.
    n = np.zeros(len(cuts) + 1, np.int64)
    for at, count in counted.collect():
        n[at] = count
    return np.cumsum(n)[:-1], int(n.sum())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id",
          text: str = "text", quality: str = "quality", rounds: int = ROUNDS) -> Model:
    """Fits the model; labels of held-out rows are not read."""
    mark = F.xxhash64("doc_id", F.lit("quality sample"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(
        F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    second = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(2)) == 1
    judged = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("quality")).filter(
        F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    ids = rows.select("doc_id").distinct()
    trusted = ids.join(judged.filter("quality = 1"), "doc_id", "left_semi")
    # At most ``sample`` ids each; an id may be in both.
    chosen = trusted.orderBy(mark).limit(sample).withColumn("trusted", F.lit(True)).union(
        ids.orderBy(mark).limit(sample).withColumn("trusted", F.lit(False))).groupBy("doc_id").agg(
        F.max("trusted").alias("trusted"), (~F.min("trusted")).alias("free"))
    texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "trusted", "free").agg(
        F.min("text").alias("text")).withColumn("second", second)
    found = sorted(_features_of(texts, ["doc_id", "trusted", "free", "second"]).collect())
    all_rows = np.frombuffer(b"".join(bytes(r["features"]) for r in found), np.float32).reshape(
        -1, FEATURES)
    is_p, is_u, later = (np.array([r[c] for r in found], bool) for c in ("trusted", "free", "second"))
    positives, unlabelled = all_rows[is_p], all_rows[is_u]
    if not all(len(part) for part in (all_rows[is_p & later], all_rows[is_p & ~later],
                                      all_rows[is_u & ~later])):
        return fit(positives, unlabelled, 0.5, rounds)
    model = scaling(positives, unlabelled)
    w = telling(_one(model.scaled(all_rows[is_p & ~later])), _one(model.scaled(all_rows[is_u & ~later])),
                rounds)
    of_p = _one(model.scaled(all_rows[is_p & later])) @ w
    cuts = cuts_of(of_p)
    prior = least_ratio(of_p, cuts, *_below(rows.filter(second), model, w, cuts))
    return fit(positives, unlabelled, prior, rounds)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The documents' columns with ``score`` and ``predicted``; columns of those names are
    replaced."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(kept.index(text)).to_pylist()
            rows = np.stack([features(t or "") for t in texts]) if texts \
                else np.zeros((0, FEATURES), np.float32)
            scores = model.scores(rows).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[*kept, "score", "predicted"])

    ship_package(docs.sparkSession)
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields],
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.select(*kept).mapInArrow(of, schema)
