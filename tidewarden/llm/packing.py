"""Packing: token sequences of near-equal length by multiway differencing (Karmarkar-Karp).

A document is its token ids and an end id. Whole windows are cut off first and are sequences of
their own. What remains is cut into even pieces of at most ``most`` ids and gathered in a pool; a
full pool is spread over the fewest windows that could hold it. Differencing starts with one partial
partition per piece and keeps merging the two whose windows differ most, the fullest window of one
with the emptiest of the other, until one partition is left. If a window is then over capacity, the
pool is spread again over one window more. A task holds one pool; pools never wait for other tasks,
so there is no shuffle, and a recomputed task packs the same rows alike.

A null text is empty and has the end id alone. Long texts are tokenised whole. Repeated rows are
packed each for itself; ties go by place in the task. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import heapq
import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import ship_package

WINDOW = 1024
#: Most ids of a piece that shares a window; a pool is spread when it fills so many windows, or holds so
#: many pieces.
MOST_PIECE = 256
POOL_WINDOWS = 192
POOL_PIECES = 1 << 16
#: Up to this letter the fast tokeniser is used; other texts go to the library the file is for.
LAST_PLAIN = "ɏ"
# Fixed: the split pattern of the byte-level vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def spread_evenly(sizes: list[int], windows: int) -> list[list[int]]:
    """Places of ``sizes`` in each window, by merging partial partitions."""
    lists: list[list[int]] = [[i] for i in range(len(sizes))]
    # A partition: the sums of its windows that hold something, in falling order, and a node for each.
    # It starts as one window and widens as it merges. Nodes beyond the pieces are pairs of nodes.
    pairs: list[tuple[int, int]] = []
    heap = [(-size, i, np.array([size]), np.array([i])) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other_sums, other_nodes = heap[0]
        # The fullest window of one goes with the emptiest of the other: they meet in the middle.
        meet = max(len(sums) + len(other_sums) - windows, 0)
        alone = len(sums) - meet
        other_sums, other_nodes = other_sums[::-1], other_nodes[::-1]
        first = len(sizes) + len(pairs)
        pairs.extend(zip(nodes[alone:].tolist(), other_nodes[:meet].tolist()))
        merged = np.concatenate((nodes[:alone], np.arange(first, first + meet), other_nodes[meet:]))
        sums = np.concatenate((sums[:alone], sums[alone:] + other_sums[:meet], other_sums[meet:]))
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        least = int(sums[-1]) if len(sums) == windows else 0
        heapq.heapreplace(heap, (least - int(sums[0]), turn, sums, merged[order]))
        turn += 1
    for left, right in pairs:
        lists.append(lists[left] + lists[right])
    return [lists[node] for node in heap[0][3].tolist()] if heap else []


def windows_of(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """As ``spread_evenly``, over as many windows as it takes to keep each within ``window``."""
    count = -(-sum(sizes) // window)
    while True:
        filled = spread_evenly(sizes, count)
        if all(sum(sizes[i] for i in places) <= window for places in filled):
            return filled
        count += 1


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file: printable ones for themselves, the others
    counted up from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def tokeniser(path: str) -> Callable[[str], list[int]]:
    """Text to ids as the byte-level BPE file at ``path`` has it.

    Plain texts are encoded with the file's vocabulary by tiktoken, which is several times as fast
    and gives the same ids; texts with the file's special tokens or letters beyond ``LAST_PLAIN`` by
    tokenizers itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    special = [t["content"] for t in parsed["added_tokens"]]
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in parsed["model"]["vocab"].items()
             if token not in special}
    plain = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if not text:
            return []
        if max(text) > LAST_PLAIN or any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return plain.encode_ordinary(text)

    return encode


def _evenly(start: int, length: int, most: int) -> Iterator[tuple[int, int]]:
    parts = -(-length // most)
    edges = [start + length * i // parts for i in range(parts + 1)]
    yield from ((a, b - a) for a, b in zip(edges, edges[1:]))


SCHEMA = ("doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, "
          "`offset` long, ids binary")


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = 0, most: int = MOST_PIECE,
         pool_windows: int = POOL_WINDOWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start and length in its document, doc_tokens, sequence_id,
    offset there, and ids (unsigned 32-bit little-endian). ``path`` names the tokeniser's file,
    which each executor has."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokeniser(path)
        first = TaskContext.get().partitionId() << 40
        made = held = 0
        pool: list[tuple] = []
        rows: list[tuple] = []
        kinds = pa.schema([("doc_id", pa.null())])

        def spread() -> None:
            nonlocal made, held
            for places in windows_of([piece[2] for piece in pool], window):
                offset = 0
                for i in sorted(places):
                    key, start, length, total, ids = pool[i]
                    rows.append((key, start, length, total, first + made, offset, ids))
                    offset += length
                made += 1
            pool.clear()
            held = 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(column, kind.type) for column, kind in zip(zip(*rows), kinds)],
                schema=kinds)
            rows.clear()
            return batch

        for batch in batches:
            kinds = pa.schema([
                ("doc_id", batch.schema.field(0).type), *[
                    (name, pa.int64()) for name in ("start", "length", "doc_tokens", "sequence_id",
                                                    "offset")], ("ids", pa.binary())])
            size = 0
            for key, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = array("I", encode(words or ""))
                ids.append(end)
                total = len(ids)
                whole = total - total % window
                for start in range(0, whole, window):
                    rows.append((key, start, window, total, first + made, 0,
                                 ids[start:start + window].tobytes()))
                    made += 1
                if total > whole:
                    for start, length in _evenly(whole, total - whole, most):
                        pool.append((key, start, length, total,
                                     ids[start:start + length].tobytes()))
                        held += length
                if held >= pool_windows * window or len(pool) >= POOL_PIECES:
                    spread()
                size += total
                if size > 1 << 20 and rows:
                    yield out()
                    size = 0
            if rows:
                yield out()
        if pool:
            spread()
            yield out()

    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        packed, SCHEMA.format(kind=kind))
