"""Spelling variants: words that differ by one letter, grouped under their most frequent form.

Pairs at an edit distance of one are found by pivotal grams. A word's bigrams are ranked by rarity
over the vocabulary; its three rarest (``2 * EDITS + 1``) with all their ties are its prefix, and of
those, dynamic programming chooses the two (``EDITS + 1``) disjoint ones with the least total
frequency, its pivots. One edit spoils at most one of two disjoint grams, and of two words the pivots of
the one whose prefix ends earlier in the ranking lie inside the other's prefix; so all prefixes are
indexed and all pivots looked up. Position limits: an edit after the first pivot leaves all up to the
pivot's end equal, at the same place from the start, one before the second pivot all from it to the
end, at the same place from the end; and of the rest one half is equal. The keys hash the side, the
equal part's length and letters, and that half, so a common gram at a common place is no hot key.
Candidates are verified by their distance.

Words are maximal runs of letters (A-Z, a-z and U+00C0 to U+00FF) of whole texts, only A-Z lower-cased,
at least ``LEAST_LENGTH`` code points long and seen ``LEAST_COUNT`` times. Every ``NOISE``-th run by a
checksum of its document and itself loses a letter first. A null text has no words; a null id is the
empty text in the checksum; repeated rows count again; ties in frequency go to the word that is first in
code-point order; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import ship_package, text_of, written

EDITS = 1
#: Longer words aren't carried along with their keys.
SHORT = 64
LEAST_LENGTH = 5
LEAST_COUNT = 3
NOISE = 97
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed: modulus and base of the rolling hash of a word's start or end.
MODULUS, BASE = (1 << 61) - 1, 1_000_003

Gram = tuple[int, str, int]


def _noisy(doc_id: Column, run: Column) -> Column:
    """The run, or the run without one letter if the checksum says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % NOISE == 0, F.concat(F.substring(run, F.lit(1), at),
                                           F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns word and n, its occurrences."""
    runs = docs.select(F.col(doc_id).alias("doc_id"), F.explode(
        F.regexp_extract_all(text_of(text), F.lit(LETTERS), F.lit(0))).alias("run"))
    words = runs.select(_noisy(F.col("doc_id"), F.translate("run", UPPER, LOWER)).alias("word"))
    return words.filter(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(
        F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def grams_of(word: str, counts: dict[str, int]) -> list[Gram]:
    """The prefix: (frequency, gram, place) of the rarest grams and all their ties, rarest first."""
    grams = sorted((counts[word[i:i + 2]], word[i:i + 2], i) for i in range(len(word) - 1))
    last = grams[min(2 * EDITS, len(grams) - 1)][:2]
    return [g for g in grams if g[:2] <= last]


def pivots_of(prefix: list[Gram]) -> list[Gram]:
    """The ``EDITS + 1`` disjoint grams of a prefix with the least total frequency."""
    placed = sorted(prefix, key=lambda g: g[2])
    # best[j]: cheapest j disjoint grams among those that end before the place at hand; a gram may
    # follow one that is two places before it.
    none = (float("inf"), None)
    best = [(0, None), *[none] * (EDITS + 1)]
    waiting: list[tuple[int, list]] = []
    for gram in placed:
        while waiting and waiting[0][0] <= gram[2] - 2:
            _, ready = waiting.pop(0)
            best = [min(a, b, key=lambda c: c[0]) for a, b in zip(best, ready, strict=True)]
        chosen = [none] + [(best[j][0] + gram[0], (gram, best[j][1])) for j in range(EDITS + 1)]
        waiting.append((gram[2], chosen))
    for _, ready in waiting:
        best = [min(a, b, key=lambda c: c[0]) for a, b in zip(best, ready, strict=True)]
    found, way = [], best[EDITS + 1][1]
    while way:
        found.append(way[0])
        way = way[1]
    return found


class Parts:
    """Hashes of the parts [i, j) of a word, each at the same cost."""

    def __init__(self, word: str) -> None:
        self.sums = list(accumulate(word, lambda h, c: (h * BASE + ord(c)) % MODULUS, initial=0))
        self.powers = list(accumulate(word, lambda p, _: p * BASE % MODULUS, initial=1))

    def __call__(self, i: int, j: int) -> int:
        return (self.sums[j] - self.sums[i] * self.powers[j - i]) % MODULUS


def _key(side: int, kept: tuple[int, int], half: int, part: tuple[int, int], parts: Parts) -> int:
    # Python's hash of a tuple of integers is the same in every process.
    return hash((side, kept[1] - kept[0], parts(*kept), half, part[1] - part[0], parts(*part)))


def _sides(at: int, size: int) -> list[tuple[int, tuple[int, int], tuple[int, int]]]:
    """With the gram at a place: its side, the part up to (from) its end, and the rest."""
    return [(0, (0, at + 2), (at + 2, size)), (1, (at, size), (0, at))]


def index_keys(word: str, counts: dict[str, int]) -> set[int]:
    """For each gram of the prefix and each side: the equal part with either half of the rest."""
    parts, keys = Parts(word), set()
    for _, _, at in grams_of(word, counts):
        for side, kept, (lo, hi) in _sides(at, len(word)):
            middle = lo + (hi - lo) // 2
            keys.add(_key(side, kept, 0, (lo, middle), parts))
            keys.add(_key(side, kept, 1, (middle, hi), parts))
    return keys


def lookup_keys(word: str, counts: dict[str, int]) -> set[int]:
    """The keys of all neighbours whose prefix holds the word's pivots: the edit comes after the first
    pivot or before the second, and in either half of the neighbour's rest."""
    first, second = sorted(g[2] for g in pivots_of(grams_of(word, counts)))
    parts, keys = Parts(word), set()
    for side, kept, (lo, hi) in (_sides(first, len(word))[0], _sides(second, len(word))[1]):
        for size in range(max(hi - lo - EDITS, 0), hi - lo + EDITS + 1):
            half = size // 2
            keys.add(_key(side, kept, 0, (lo, lo + half), parts))
            if size - half <= hi - lo:
                keys.add(_key(side, kept, 1, (hi - (size - half), hi), parts))
    return keys


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter(word[i:i + 2] for word in batch.column(0).to_pylist()
                         for i in range(len(word) - 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
            names=["gram", "n"])


def near_pairs(words: DataFrame) -> DataFrame:
    """Of words (id, word): the ids (a < b) of those at a distance of one edit, each pair once."""
    spark = words.sparkSession
    ship_package(spark)
    counted = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(
        F.sum("n").alias("n"))
    # At most 90 ** 2 grams: there are 26 + 64 letters.
    counts = {r.gram: r.n for r in counted.collect()}

    def keyed(keys_of: Callable[[str, dict[str, int]], set[int]], name: str) -> DataFrame:
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 1000):
                    part = batch.slice(start, 1000)
                    texts = part.column(1).to_pylist()
                    made = [keys_of(word, counts) for word in texts]
                    rows = pa.array(np.repeat(np.arange(len(made)), [len(m) for m in made]))
                    ids = pa.array(part.column(0).to_pylist(), pa.int64())
                    short = pa.array([w if len(w) <= SHORT else None for w in texts], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chain.from_iterable(made), pa.int64()), ids.take(rows), short.take(rows)],
                        names=["key", name, f"{name}_word"])
        return words.select("id", "word").mapInArrow(of, f"key long, {name} long, {name}_word string")

    near = F.levenshtein("a_word", "b_word", EDITS) == EDITS
    found = keyed(lookup_keys, "a").hint("merge").join(keyed(index_keys, "b"), "key").filter(
        F.col("a") != F.col("b")).filter(near | F.isnull("a_word") | F.isnull("b_word")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
            (F.isnull("a_word") | F.isnull("b_word")).alias("open")).distinct()
    found = written(found, "candidates")
    # Index rows don't carry long words; those are looked up.
    unread = found.filter("open").drop("open")
    for end in ("a", "b"):
        unread = unread.hint("merge").join(words.select(
            F.col("id").alias(end), F.col("word").alias(f"{end}_word")), end)
    return found.filter("not open").select("a", "b").union(unread.filter(near).select("a", "b"))


def roots_of(ups: DataFrame) -> DataFrame:
    """Of (id, up), where up is the next id or the id itself: (id, up) with the last."""
    moved = True
    while moved:
        above = ups.select(F.col("id").alias("up"), F.col("up").alias("top"))
        ups = written(ups.hint("merge").join(above, "up").select(
            "id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "roots")
        moved = not ups.filter("moved").isEmpty()
        ups = ups.select("id", "up")
    return ups


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each word: its frequency ``n``, the number of words one edit away ``n_near``, the most
    frequent of these if at least twice as frequent (``form``, ``form_n``), and the ``root`` that forms
    lead to."""
    words = written(vocabulary(docs, doc_id, text).withColumn("id", F.monotonically_increasing_id()),
                    "words")
    pairs = written(near_pairs(words), "near")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The most frequent neighbour is the least of these structs; its id comes along.
    best = both.hint("merge").join(words.select(
        F.col("id").alias("b"), F.struct((-F.col("n")).alias("less"), "word", "id").alias("other")),
        "b").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    forms = written(words.hint("merge").join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best")).alias("form")), "forms")
    roots = roots_of(forms.select("id", F.coalesce("form.id", "id").alias("up")))
    named = words.select(F.col("id").alias("up"), F.col("word").alias("root"))
    return forms.hint("merge").join(roots, "id").hint("merge").join(named, "up").select(
        "word", F.col("form.word").alias("form"), "root", "n", "n_near",
        (-F.col("form.less")).alias("form_n"))
