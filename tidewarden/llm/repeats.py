"""Removal of passages that repeat across documents, by suffix automata of reference shards.

Of any passage of ``WINDOW`` words in a row that several documents hold, the document with the smallest id
keeps it; the others lose each word that such a window covers. Windows are judged on the input.

Reference: each window is charged to its anchor, the smallest hash among its runs of ``GRAM`` words, and the
windows of a document that share an anchor lie in a row, its context. Only anchors that occur in several
documents go on. Equal contexts are settled as one; where an anchor has different contexts, each window
of one context of a kind is hashed. So each window that may repeat gets its first document, and what
those documents hold of such windows is the reference: every repeated passage about once, cut into
blocks of ``BLOCK`` words and dealt to shards of about ``SHARD`` words.

Match: a task builds the suffix automaton of a shard, with the smallest document of each state, and streams
what other documents may share with it through it. The automaton's matching statistics tell, for every
place, the longest passage of the shard that ends there; where its last ``WINDOW`` words come from a
smaller document they are removed. Hashes only choose candidates; words are compared by the automaton. As
the reference grows with the corpus, a shard is sent to the tasks that need it, not to all: a passage
that many documents share has its shard copied to one task for each ``SLICE`` words that stream by.

Documents are written once, dealt by row number into a bucketed table, so that no later join moves texts.
A null text has no words. A null id counts as smaller than all others; documents with equal ids, repeated
rows included, don't take from each other, and each row is judged. Long texts are whole: contexts and
passages are cut with overlaps. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import ship_package, text_of, written
from tidewarden.session import shared_folder

WINDOW = 50
GRAM = 8
#: Words (windows, for contexts) in a block of the reference; in a shard; that stream through a copy of it.
BLOCK = 2048
SHARD = 100_000
SLICE = 1_000_000
#: Bytes of text in a bucket, if there are more than the session's shuffle partitions hold.
BUCKET_BYTES = 128 << 20
#: Bytes hashed at once.
PIECE = 1 << 20

# Fixed: odd multipliers of the rolling hashes and of the final mixing.
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

Batches = Iterator[pa.RecordBatch]
OWN = ("own_d", "own_rid", "own_start")


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``count`` powers of the base from 0, and their inverses."""
    if len(_powers[0]) < count:
        size = max(count, 2 * len(_powers[0]))
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            column = np.full(size, base, np.uint64)
            column[0] = 1
            _powers[k] = np.cumprod(column)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def run_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, stop) of the values."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes and the bytes they start at, some of the text at a time."""
    codes = np.frombuffer(data, np.uint8)
    edges = np.diff(np.concatenate(([True], _SPACE[codes], [True])).astype(np.int8))
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(stops, starts[at] + PIECE, "right")), at + 1)
        first = starts[at]
        hashes[at:to] = run_hashes(codes[first:stops[to - 1]].astype(np.uint64) + np.uint64(1),
                                   starts[at:to] - first, stops[at:to] - first)
        at = to
    return hashes, starts


def contexts_of(hashes: np.ndarray, texts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of the words of some texts in a row (``texts``: the text of each word): for each context its
    anchor, its hash, the place of its first window and the number of its windows."""
    n = len(hashes)
    if n < window:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    at = np.arange(n - GRAM + 1)
    least = run_hashes(hashes, at, at + GRAM)
    reach, need = 1, window - GRAM + 1
    while reach < need:
        step = min(reach, need - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    places = np.flatnonzero(texts[:n - window + 1] == texts[window - 1:])
    if not len(places):
        return contexts_of(hashes[:0], texts, window)
    anchors, of = least[places], texts[places]
    new = np.flatnonzero(np.concatenate(
        ([True], (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1]))))
    sizes = np.diff(np.append(new, len(places)))
    # Long contexts are cut, counted from their start.
    pieces = -(-sizes // BLOCK)
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    new = np.repeat(new, pieces) + within * BLOCK
    sizes = np.minimum(np.repeat(sizes, pieces) - within * BLOCK, BLOCK)
    first = places[new]
    return anchors[new], run_hashes(hashes, first, first + sizes + window - 1), first, sizes


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of about a piece together, with the row of the first; the text is the last column."""
    rows: list[bytes] = []
    first, size = 0, 0
    column = batch.column(batch.num_columns - 1)
    for i in range(batch.num_rows):
        rows.append(column[i].as_py().encode())
        size += len(rows[-1])
        if size >= PIECE or i == batch.num_rows - 1:
            yield first, rows
            rows, first, size = [], i + 1, 0


def _anchors(window: int, whole: bool):
    """From (rid, d, text): anchor, context, d, rid, start and n of each context, or anchor and d."""
    def of(batches: Batches) -> Batches:
        for batch in batches:
            rids, ds = (batch.column(i).to_numpy() for i in range(2))
            for first, rows in _groups(batch):
                found = [word_hashes(row)[0] for row in rows]
                counts = np.array([len(f) for f in found])
                texts = np.repeat(np.arange(len(rows)), counts)
                begin = np.cumsum(counts) - counts
                anchors, contexts, places, sizes = contexts_of(np.concatenate(found), texts, window)
                of_text = texts[places]
                columns = {"anchor": _signed(anchors), "d": pa.array(ds[first + of_text], pa.int64())}
                if whole:
                    columns |= {"context": _signed(contexts),
                                "rid": pa.array(rids[first + of_text], pa.int64()),
                                "start": pa.array(places - begin[of_text], pa.int64()),
                                "n": pa.array(sizes, pa.int64())}
                yield pa.RecordBatch.from_pydict(columns)
    return of


def _windows(window: int):
    """From (rid, d, ranges, text): hash, d, rid and start of each window of the ranges."""
    def of(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(batch.num_rows):
                rid, d, ranges, text = (batch.column(c)[i].as_py() for c in range(4))
                hashes, _ = word_hashes(text.encode())
                starts = np.unique(np.concatenate(
                    [np.arange(r["start"], r["start"] + r["n"]) for r in ranges]))
                for at in range(0, len(starts), 1 << 16):
                    part = starts[at:at + (1 << 16)]
                    lo = int(part[0])
                    yield pa.RecordBatch.from_arrays(
                        [_signed(run_hashes(hashes[lo:int(part[-1]) + window], part - lo,
                                            part - lo + window)),
                         pa.array(np.full(len(part), d), pa.int64()),
                         pa.array(np.full(len(part), rid), pa.int64()), pa.array(part, pa.int64())],
                        names=["hash", "d", "rid", "start"])
    return of


def joined_runs(ranges: list[tuple[int, int]], window: int) -> Iterator[tuple[int, int]]:
    """The windows [start, start + n) of the ranges as runs of words [from, to), which hold each
    window whole and are ``BLOCK`` windows long at most."""
    runs: list[list[int]] = []
    for start, n in sorted(ranges):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], start + n)
        else:
            runs.append([start, start + n])
    for start, stop in runs:
        for at in range(start, stop, BLOCK):
            yield at, min(at + BLOCK, stop) + window - 1


def _passages(window: int):
    """From (rid, d, items, text): the words that a shard takes as reference or that stream by it."""
    def of(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(batch.num_rows):
                rid, d, items, text = (batch.column(c)[i].as_py() for c in range(4))
                data = text.encode()
                _, begins = word_hashes(data)
                begins = np.append(begins, len(data))
                by: dict[tuple, list] = {}
                for item in items:
                    key = item["shard"], item["owner"], item["block"], item["refers"]
                    by.setdefault(key, []).append((item["start"], item["n"]))
                made = [{"shard": shard, "refers": refers, "d": d, "rid": rid, "start": lo,
                         "words": data[begins[lo]:begins[hi]].decode()}
                        for (shard, _, _, refers), ranges in by.items()
                        for lo, hi in joined_runs(ranges, window)]
                for at in range(0, len(made), 1000):
                    yield pa.RecordBatch.from_pylist(made[at:at + 1000], schema=pa.schema([
                        ("shard", pa.int64()), ("refers", pa.bool_()), ("d", pa.int64()),
                        ("rid", pa.int64()), ("start", pa.int64()), ("words", pa.string())]))
    return of


class Automaton:
    """Suffix automaton of passages of words, with the smallest document of each state.

    Passages are added in ascending order of their documents, so the first one to make a state is its
    smallest."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.after: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.document = [0]

    def add(self, words: list[bytes], document: int) -> None:
        after, link, length, documents = self.after, self.link, self.length, self.document
        ids = self.ids
        last = 0
        for word in words:
            c = ids.setdefault(word, len(ids))
            q = after[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            if q is not None:
                last = self._split(last, c, q)
                continue
            state = len(after)
            after.append({})
            length.append(length[last] + 1)
            link.append(0)
            documents.append(document)
            p = last
            while p >= 0 and c not in after[p]:
                after[p][c] = state
                p = link[p]
            if p >= 0:
                q = after[p][c]
                link[state] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = state

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the longest text of ``p`` and then ``c``, taken out of ``q``."""
        after, link = self.after, self.link
        state = len(after)
        after.append(dict(after[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        self.document.append(self.document[q])
        link[q] = state
        while p >= 0 and after[p].get(c) == q:
            after[p][c] = state
            p = link[p]
        return state

    def spans(self, words: list[bytes], document: int, window: int) -> list[tuple[int, int]]:
        """Maximal spans covered by windows that also lie in a smaller document."""
        after, link, length, documents, ids = self.after, self.link, self.length, self.document, self.ids
        found: list[list[int]] = []
        state, matched = 0, 0
        for i, word in enumerate(words):
            c = ids.get(word, -1)
            while state and c not in after[state]:
                state = link[state]
                matched = length[state]
            if c not in after[state]:
                continue
            state = after[state][c]
            matched += 1
            if matched >= window:
                # Up to the state of the last ``window`` words.
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                if documents[state] < document:
                    if found and i - window + 1 <= found[-1][1]:
                        found[-1][1] = i + 1
                    else:
                        found.append([i - window + 1, i + 1])
        return [(lo, hi) for lo, hi in found]


def _matches(window: int):
    def of(references: pa.Table, streams: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if streams.num_rows:
            automaton = Automaton()
            for i in np.lexsort([references[c].to_numpy() for c in ("start", "rid", "d")]).tolist():
                automaton.add(references["words"][i].as_py().encode().split(), references["d"][i].as_py())
            for rid, d, start, words in zip(*(streams[c] for c in ("rid", "d", "start", "words")),
                                            strict=True):
                begin = start.as_py()
                found += [(rid.as_py(), begin + lo, begin + hi) for lo, hi in
                          automaton.spans(words.as_py().encode().split(), d.as_py(), window)]
        return pa.table({name: pa.array([f[k] for f in found], pa.int64())
                         for k, name in enumerate(("rid", "start", "stop"))})
    return of


def _kept(batches: Batches) -> Batches:
    """From (doc_id, spans, text) to doc_id, n_words, n_removed, spans (maximal) and kept."""
    for batch in batches:
        n_words, n_removed, merged, kept = [], [], [], []
        for i in range(batch.num_rows):
            words = batch.column(2)[i].as_py().encode().split()
            whole: list[list[int]] = []
            for lo, hi in sorted((s["start"], s["stop"]) for s in batch.column(1)[i].as_py() or []):
                if whole and lo <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], hi)
                else:
                    whole.append([lo, hi])
            n_words.append(len(words))
            n_removed.append(sum(hi - lo for lo, hi in whole))
            for lo, hi in reversed(whole):
                del words[lo:hi]
            merged.append([{"start": lo, "stop": hi} for lo, hi in whole])
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
             pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept"])


class _Dealt:
    """Documents as a table bucketed by row number ``rid``, with d, the id that is never null."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str) -> None:
        spark = docs.sparkSession
        rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
        name = f"repeats_{uuid.uuid4().hex}"
        (rows.withColumn("rid", F.monotonically_increasing_id())
         .withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)))
         .repartition(self.parts, "rid").write.bucketBy(self.parts, "rid")
         .option("path", shared_folder(spark, "documents")).option("compression", "zstd")
         .saveAsTable(name))
        self.rows = spark.table(name)

    def with_lists(self, rows: DataFrame, name: str, *columns: str, how: str = "inner") -> DataFrame:
        """The documents with the rows of their number as an array; the texts stay where they are."""
        lists = rows.repartition(self.parts, "rid").groupBy("rid").agg(
            F.collect_list(F.struct(*columns)).alias(name))
        return self.rows.join(lists.hint("shuffle_hash"), "rid", how)


def _first() -> list[Column]:
    """The smallest document of a group, one of its rows and a place there, and the largest."""
    # All of fixed width, so this is a hash aggregate; the row and the place are those of one input row.
    return [F.min("d").alias("own_d"), F.min_by("rid", "d").alias("own_rid"),
            F.min_by("start", "d").alias("own_start"), F.max("d").alias("last")]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """A row for each document: doc_id, n_words, n_removed, the removed ``spans`` of words, and the
    ``kept`` words joined by a space."""
    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    dealt = _Dealt(docs, doc_id, text)
    texts = dealt.rows.select("rid", "d", "text")

    # Contexts of anchors that several documents have.
    shared = texts.mapInArrow(_anchors(window, False), "anchor long, d long").groupBy("anchor").agg(
        F.min("d").alias("first"), F.max("d").alias("last")).filter("first < last").select("anchor")
    contexts = written(texts.mapInArrow(
        _anchors(window, True), "anchor long, d long, context long, rid long, start long, n long")
        .hint("merge").join(written(shared, "anchors"), "anchor"), "contexts")

    # Of each kind of context the first document; its windows, if the anchor has several kinds.
    kinds = written(contexts.groupBy("anchor", "context", "n").agg(*_first()), "kinds")
    several = kinds.groupBy("anchor").agg((F.count("*") > 1).alias("several"))
    kinds = kinds.hint("merge").join(several, "anchor").filter("several or own_d < last")
    placed = written(contexts.hint("merge").join(kinds, ["anchor", "context", "n"]).select(
        "rid", "d", "start", "n", *OWN, "last", "several"), "placed")
    unsettled = placed.filter("several and d = own_d")
    windows = dealt.with_lists(unsettled, "ranges", "start", "n").select(
        "rid", "d", "ranges", "text").mapInArrow(
            _windows(window), "hash long, d long, rid long, start long")
    owned = windows.groupBy("hash").agg(*_first()).filter("own_d < last")

    # What is shared, with the document that keeps it.
    copies = placed.filter("own_d < last").select("rid", "d", "start", "n", *OWN)
    alike = windows.hint("merge").join(owned.select("hash", *OWN), "hash").select(
        "rid", "d", "start", F.lit(1).cast("long").alias("n"), *OWN)
    items = written(copies.union(alike).select(
        "rid", "start", "n", F.col("own_rid").alias("owner"),
        F.expr(f"own_start div {BLOCK}").alias("block"), (F.col("d") == F.col("own_d")).alias("refers"))
        # A document with the keeper's id neither gives nor loses anything.
        .filter("not refers or rid = owner"), "items")

    size = items.filter("refers").agg(F.sum(F.col("n") + window)).first()[0] or 0
    shards = max(1, -(-size // SHARD))
    dealt_items = items.withColumn("shard", F.pmod(F.xxhash64("owner", "block"), F.lit(shards)))
    passages = written(dealt.with_lists(
        dealt_items, "items", "shard", "owner", "block", "refers", "start", "n").select(
            "rid", "d", "items", "text").mapInArrow(
                _passages(window),
                "shard long, refers boolean, d long, rid long, start long, words string"), "passages")

    # Copies of a shard for what streams by it.
    slices = passages.filter("not refers").groupBy("shard").agg(
        F.ceil(F.sum(F.octet_length("words")) / (6 * SLICE)).alias("slices"))
    sliced = passages.join(slices, "shard")
    references = sliced.filter("refers").select(
        "shard", "d", "rid", "start", "words",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    references = references.toDF(*references.columns)  # columns of its own, apart from the streams'
    streams = sliced.filter("not refers").select(
        "shard", "d", "rid", "start", "words", F.pmod(F.xxhash64("rid", "start"), "slices").alias("slice"))
    spans = written(references.groupBy("shard", "slice").cogroup(streams.groupBy("shard", "slice"))
                    .applyInArrow(_matches(window), "rid long, start long, stop long"), "spans")

    return dealt.with_lists(spans, "spans", "start", "stop", how="left").select(
        "doc_id", "spans", "text").mapInArrow(
            _kept, f"doc_id {kind}, n_words long, n_removed long, "
                   "spans array<struct<start: bigint, stop: bigint>>, kept string")
