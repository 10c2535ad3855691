"""Document fingerprints by winnowing.

Each k characters of a text in a row are hashed by a rolling polynomial; of each window of w hashes
in a row the smallest is chosen, the rightmost of equal ones, and what any window chose is the
fingerprint, with its place. Two texts that share a passage of at least w + k - 1 characters share a
chosen hash of it; passages under k characters never match.

The window is ``WINDOW`` hashes for long texts and an eighth of the hashes for shorter ones, so that
a short text has several. What a window chooses, each narrower window of the same text chooses too,
so texts with different windows keep the guarantee of the wider one. The likeness of two texts is that
of what one window chooses in both, the narrower of theirs.

As a string a fingerprint is twelve hex digits for each chosen hash, in text order: ten of the hash,
two of the distance from the place before (the first: from the start). Equal texts have equal
fingerprints. A text shorter than k is one hash; a null or empty text has the empty fingerprint.
Long texts are hashed block by block, in memory that does not grow with them beyond the text itself.
Repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import ship_package

K = 12
#: At most 255, as distances are two hex digits.
WINDOW = 64
#: A window of a short text: its hashes divided by this.
SHORT = 8
#: Hashes that are handled at once; under 2 ** 24, as a place in a block has 24 bits.
BLOCK = 1 << 20
# Fixed: odd multipliers of the rolling and of the final mixing.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def rolling_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """40-bit hashes of each k codes in a row; of all of them if there are fewer."""
    size = min(k, len(codes))
    count = len(codes) - size + 1
    wide = codes.astype(np.uint64) + np.uint64(1)
    hashes = np.zeros(count, np.uint64)
    for i in range(size):
        hashes = hashes * BASE + wide[i:i + count]
    hashes ^= hashes >> np.uint64(31)
    hashes *= MIX
    return hashes >> np.uint64(24)


def smallest_places(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of each window, the rightmost of equal ones, each place once."""
    mark = np.uint64((1 << 24) - 1)
    keys = (hashes << np.uint64(24)) | (mark - np.arange(len(hashes), dtype=np.uint64))
    reach = 1
    while reach < window:
        step = min(reach, window - reach)
        keys = np.minimum(keys[:-step], keys[step:])
        reach += step
    places = (mark - (keys & mark)).astype(np.int64)
    return places[np.concatenate(([True], places[1:] != places[:-1]))]


def width_of(text: str, k: int = K, window: int = WINDOW) -> int:
    """The window of a text."""
    return max(1, min(window, max(len(text) - k + 1, 1) // SHORT))


def winnow(text: str, k: int = K, window: int = WINDOW,
           width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a text that its window, or one of ``width``, chooses and their places, in text
    order."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    count = max(len(codes) - k + 1, 1)
    width = width_of(text, k, window) if width is None else min(width, count)
    chosen, places, last = [], [], -1
    # Blocks of windows; a block reads the codes of its last window to the end.
    for start in range(0, count - width + 1, BLOCK):
        stop = min(start + BLOCK, count - width + 1)
        hashes = rolling_hashes(codes[start:stop + width + k - 2], k)
        at = smallest_places(hashes, width)
        at = at[at + start > last]
        last = max(last, start + int(at[-1])) if len(at) else last
        chosen.append(hashes[at])
        places.append(at + start)
    return np.concatenate(chosen), np.concatenate(places)


def as_string(hashes: np.ndarray, places: np.ndarray) -> str:
    steps = np.diff(places, prepend=0)
    packed = np.empty((len(hashes), 6), np.uint8)
    packed[:, :5] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
    packed[:, 5] = steps
    return packed.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two texts' distinct hashes; 1 if both have none."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 1.0


def text_likeness(a: str, b: str, of_a: np.ndarray, of_b: np.ndarray, k: int = K,
                  window: int = WINDOW) -> float:
    """Likeness of two texts with these chosen hashes; a text with the wider window is winnowed again
    with the narrower."""
    at_a, at_b = width_of(a, k, window), width_of(b, k, window)
    if at_a > at_b:
        of_a = winnow(a, k, window, at_b)[0]
    elif at_b > at_a:
        of_b = winnow(b, k, window, at_a)[0]
    return likeness(of_a, of_b)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                 window: int = WINDOW) -> DataFrame:
    """Columns doc_id and fingerprint, a row for each document."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_string(*winnow(t or "", k, window)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        of, f"doc_id {kind}, fingerprint string")


def _edges(docs: DataFrame, parts: int) -> list:
    """Ids that cut the documents into ``parts`` runs of about equal length."""
    cuts = [i / parts for i in range(1, parts)]
    found = docs.select(F.percentile_approx("doc_id", cuts, 100 * parts)).first()[0]
    return sorted(set(found or []))


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                    window: int = WINDOW, parts: int | None = None) -> DataFrame:
    """Each document against its edited text, whose last half is the start of the next document by
    falling id (after the last: the first; equal ids by text, a null id last).

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. Documents are dealt out by runs of ids and sorted in them; the first of a run is also
    sent, once, to the run before it. A task keeps one document beside the current one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = _edges(rows, parts)

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: len(edges) - bisect.bisect_right(edges, i)).astype("int32")

    # Ids reach Python without nulls, which would make them floating-point numbers.
    placed = rows.withColumn("run", F.when(F.col("doc_id").isNull(), len(edges)).otherwise(
        run_of(F.coalesce("doc_id", F.lit(edges[0])))) if edges else F.lit(0))
    # One row for each run: its first document.
    firsts = sorted((r["run"], r["first"]) for r in placed.groupBy("run").agg(
        F.max("doc_id").alias("first")).collect())
    heads = spark.createDataFrame(
        [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)],
        f"head {docs.schema[doc_id].dataType.simpleString()}, before int")
    # A row for each run, so at most ``parts``.
    first_text = rows.join(F.broadcast(heads), rows.doc_id.eqNullSafe(heads["head"])).groupBy(
        "doc_id", "before").agg(F.min("text").alias("text"))
    sent = placed.withColumn("is_next", F.lit(False)).unionByName(first_text.select(
        "doc_id", "text", F.col("before").alias("run"), F.lit(True).alias("is_next")))
    dealt = sent.repartition(F.col("run")).sortWithinPartitions(
        "run", "is_next", F.col("doc_id").desc_nulls_last(), "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for key, text, at, is_next in zip(*[c.to_pylist() for c in batch.columns]):
                found = winnow(text, k, window)
                if held is not None and held[0] == at:
                    _, held_key, held_text, held_found = held
                    half = len(held_text) // 2
                    edited = held_text[:len(held_text) - half] + text[:half]
                    of_edited = winnow(edited, k, window)
                    out.append((
                        held_key, len(held_text),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_string(*held_found), as_string(*of_edited),
                        text_likeness(held_text, edited, held_found[0], of_edited[0], k, window),
                        text_likeness(held_text, text, held_found[0], found[0], k, window)))
                held = None if is_next else (at, key, text, found)
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int64()),
                 *[pa.array(c, pa.string()) for c in columns[2:5]],
                 *[pa.array(c, pa.float64()) for c in columns[5:]]],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])

    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return dealt.select("doc_id", "text", "run", "is_next").mapInArrow(
        compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
