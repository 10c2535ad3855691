"""N-gram Jaccard join by a MinHash LSH forest.

Each text becomes the set of its five-word shingles and a signature of ``TREES * DEPTH`` minimum
hashes. Tree t reads the signature's t-th part as a path; sorted by their paths, texts form a prefix
trie, and those with long common prefixes lie side by side. Each text is paired with the ``NEXT`` that
follow it. Candidates are pairs whose prefix is long enough in some tree: starting from the whole
path, the prefix is shortened until the estimated recall reaches its target. The estimate weighs each
pair found by the chance that its similarity had to be found at that depth; never shorter than
``FLOOR``, where a pair at the threshold itself is found with probability 0.99999. However many texts
share a prefix of that length in a tree, each is then compared with all of them by signatures; pairs
that shorter prefixes have found stay candidates.

Candidates that the whole signatures put far below the threshold are left out. The others form
families (connected components), and every pair of a family is then verified exactly on the shingle
sets: a family is cut into blocks, a task compares two blocks and hands on one row per member, never
pairs. So a link of two texts is found if their family holds both, even if no tree put them together.

Words are runs of other than white space. A text of fewer than five words is one shingle; texts
without words (null, empty, blank) share one set and are copies of each other. Texts with equal sets
are copies; they are compared once and counted as often as they occur. Repeated rows are copies too.
Ids are integers; a null id is kept and never names a class; an id with different texts has a row for
each, judged by its own text. Very long texts are hashed whole. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import ship_package, written
from tidewarden.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
TREES, DEPTH, FLOOR = 24, 8, 4
RECALL = 0.999
#: Texts that follow in a tree with which a text is paired.
NEXT = 3
#: Candidates whose signatures agree in less than this share (over six deviations under 0.8) go.
LEAST_AGREEMENT = 0.62
#: Members of a block; a task compares two blocks.
BLOCK = 64
#: Texts of a block of those that share a prefix; only signatures are compared there.
RUN_BLOCK = 256
_SPACES = re.compile("[\x20\x09-\x0d]+")
# Fixed: an odd base of the polynomial over bytes, its inverse modulo 2 ** 64, mixing multipliers.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SIZE = 1 << 16


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _SIZE), _powers(_INVERSE, _SIZE)
_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _random.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)


def _spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes: the polynomial of its bytes, wherever it lies."""
    if len(raw) <= _SIZE:
        up, down = _UP[:len(raw)], _DOWN
    else:
        up, down = _powers(_BASE, len(raw)), _powers(_INVERSE, len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(up * (raw.astype(np.uint64) + 1),
                                                             dtype=np.uint64)))
    hashes = (sums[ends] - sums[starts]) * down[starts]
    for mix in _MIX:
        hashes ^= hashes >> np.uint64(33)
        hashes *= mix
    return hashes ^ (hashes >> np.uint64(33))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's runs of ``size`` words."""
    words = [w for w in _SPACES.split(text) if w]
    if not words:
        return np.zeros(0, np.uint64)
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    raw = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(raw)]))
    size = min(size, len(words))
    return np.unique(_spans(raw, starts[:len(starts) - size + 1], ends[size - 1:]))


def signature(found: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest hash of each function; zeros for the empty set."""
    if not len(found):
        return np.zeros(TREES * DEPTH, np.uint16)
    low = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
    smallest = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 256):
        rows = low[start:start + 256, None] * _FACTORS
        rows += _TERMS
        np.minimum(smallest, rows.min(0), out=smallest)
    return smallest.astype(np.uint16)


def set_digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def text_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, text_md5, digest (of the shingle set) and signature, a row per document."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            md5, digests, signatures = [], [], []
            for words in batch.column(1).to_pylist():
                found = shingles(words or "")
                md5.append(hashlib.md5((words or "").encode("utf-8", "surrogatepass")).digest())
                digests.append(set_digest(found))
                signatures.append(signature(found).astype(">u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.binary()) for c in (md5, digests, signatures)]],
                names=["doc_id", "text_md5", "digest", "signature"])

    ship_package(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(of, "doc_id long, text_md5 binary, digest binary, signature binary")


def distinct_sets(sets: DataFrame) -> DataFrame:
    """One row for each shingle set: digest, the first document that has it (no_id, id, text_md5),
    copies and signature."""
    return sets.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), "text_md5"))
        .alias("first"), F.count("*").alias("copies"), F.min("signature").alias("signature")).select(
        "digest", "first.*", "copies", "signature")


def trie_pairs(texts: DataFrame, floor: int = FLOOR, following: int = NEXT) -> DataFrame:
    """Columns a, b (digests) and depth: neighbours in some tree, and the longest prefix that they
    share in any."""
    # A path: the tree, its part of the signature, then the digest, by which texts with equal parts
    # can be dealt out to several tasks.
    path = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.concat(
        F.unhex(F.lpad(F.hex(t), 2, "0")),
        F.call_function("substring", F.col("signature"), t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)),
        F.col("digest"))))
    paths = texts.select(path.alias("path")).repartitionByRange("path").sortWithinPartitions("path")
    end = 1 + 2 * DEPTH

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[bytes] = []
        for batch in batches:
            out: list[tuple[bytes, bytes, int]] = []
            for path in batch.column(0).to_pylist():
                for other in before:
                    if path[:1 + 2 * floor] != other[:1 + 2 * floor]:
                        continue
                    depth = floor
                    while depth < DEPTH and path[:3 + 2 * depth] == other[:3 + 2 * depth]:
                        depth += 1
                    out.append((min(path[end:], other[end:]), max(path[end:], other[end:]), depth))
                before = [*before[1 - following:], path] if following > 1 else [path]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()),
                 pa.array(columns[2], pa.int32())], names=["a", "b", "depth"])

    return paths.mapInArrow(neighbours, "a binary, b binary, depth int").groupBy("a", "b").agg(
        F.max("depth").alias("depth"))


def agreement(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs with the share of their signatures that agrees, an estimate of the similarity."""
    signed = pairs.join(texts.select(
        F.col("digest").alias("a"), F.col("signature").alias("of_a")), "a") \
        .join(texts.select(F.col("digest").alias("b"), F.col("signature").alias("of_b")), "b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(
                -1, TREES * DEPTH) for i in (3, 4))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array((one == two).mean(1) if len(one) else [],
                                              pa.float64())],
                names=["a", "b", "depth", "agreement"])

    return signed.select("a", "b", "depth", "of_a", "of_b").mapInArrow(
        agree, "a binary, b binary, depth int, agreement double")


def chosen_depth(pairs: DataFrame, target: float = RECALL, similarity: float = SIMILARITY) -> int:
    """The longest prefix at which the pairs found make up ``target`` of those estimated to exist."""
    tally = pairs.filter(F.col("agreement") >= similarity).groupBy(
        "depth", F.round("agreement", 2).alias("s")).agg(F.count("*").alias("n")).collect()
    in_all = sum(r["n"] for r in tally)
    for depth in range(DEPTH, FLOOR, -1):
        found = [(r["n"], min(r["s"], 1.0)) for r in tally if r["depth"] >= depth]
        # Those that shorter prefixes have found exist for certain.
        exist = max(in_all, sum(n / (1 - (1 - s ** depth) ** TREES) for n, s in found))
        at_threshold = 1 - (1 - similarity ** depth) ** TREES
        if at_threshold >= target and sum(n for n, _ in found) >= target * exist:
            return depth
    return FLOOR


def run_links(placed: DataFrame, depth: int, block: int = RUN_BLOCK) -> DataFrame:
    """Columns a, b (families) that hold a candidate pair, from digest, signature and family: every
    pair of texts that share a prefix of ``depth`` in some tree is compared, but those of one family.

    A run of equal prefixes is cut into blocks, a task compares two blocks and hands on fewer rows
    than it has families, never pairs.
    """
    run = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(
        t, F.call_function("substring", F.col("signature"), t * (2 * DEPTH) + 1,
                           F.lit(2 * depth)))))
    runs = placed.select(run.alias("run"), F.xxhash64("family").alias("of")).groupBy("run").agg(
        F.count("*").alias("members"), F.min("of").alias("least"), F.max("of").alias("most")) \
        .filter("least <> most").select("run", F.ceil(F.col("members") / block).cast("int").alias(
            "blocks"))
    units = placed.select(run.alias("run"), "digest").join(runs, "run").withColumn(
        "block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "run", "digest", F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second")).join(placed, "digest")

    def compare(rows: pa.Table) -> pa.Table:
        names, of = np.unique(np.array(rows.column("family").to_pylist(), object),
                              return_inverse=True)
        signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()),
                                   np.uint16).reshape(-1, TREES * DEPTH)
        family, links = of.copy(), []
        for x in range(len(of)):
            others = x + 1 + np.flatnonzero(of[x + 1:] != of[x])
            agree = np.count_nonzero(signatures[others] == signatures[x], axis=1)
            for y in others[agree >= LEAST_AGREEMENT * TREES * DEPTH]:
                if of[y] != of[x]:
                    links.append((names[family[x]], names[family[y]]))
                    of[of == of[y]] = of[x]
        columns = list(zip(*links)) or [()] * 2
        return pa.table({"a": pa.array(columns[0], pa.binary()),
                         "b": pa.array(columns[1], pa.binary())})

    return units.select("run", "first", "second", "family", "signature").groupBy(
        "run", "first", "second").applyInArrow(compare, "a binary, b binary")


def candidate_families(texts: DataFrame, target: float = RECALL, similarity: float = SIMILARITY
                       ) -> DataFrame:
    """Columns digest and family, of the texts (digest, signature) that are in some candidate pair."""
    pairs = written(agreement(trie_pairs(texts), texts).filter(
        F.col("agreement") >= LEAST_AGREEMENT), "pairs")
    depth = chosen_depth(pairs, target, similarity)
    near = components(pairs).select(
        F.col("id").alias("digest"), F.col("class").alias("family"))
    placed = written(texts.select("digest", "signature").join(near, "digest", "left").select(
        "digest", "signature", F.coalesce("family", "digest").alias("family")), "placed")
    merged = components(run_links(placed, depth)).select(
        F.col("id").alias("family"), F.col("class").alias("whole"))
    single = merged.select(F.col("family").alias("digest")).join(near, "digest", "left_anti")
    return near.unionByName(single.withColumn("family", F.col("digest"))).join(
        merged, "family", "left").select("digest", F.coalesce("whole", "family").alias("family"))


#: What names a document's text: two documents of one id may differ.
_ROW = ["no_id", "id", "text_md5"]


def keyed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``_ROW`` and the text; a null text is empty."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"),
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_md5"), "text")


def verified(families: DataFrame, docs: DataFrame, similarity: float = SIMILARITY,
             doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Columns digest, root and links, from the rows of ``distinct_sets`` with their family: one row
    for each member and pair of blocks, with the smallest member that it is linked to there, and how
    many documents its links there stand for."""
    sizes = families.groupBy("family").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / block).cast("int")
    placed = families.join(sizes, "family").filter("members > 1").withColumn(
        "blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    # A block meets itself and every other one.
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", "digest", *_ROW, "copies", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    with_text = units.join(keyed_texts(docs, doc_id, text), _ROW)

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        first, second = key[1].as_py(), key[2].as_py()
        members: dict[bytes, tuple[np.ndarray, int, int]] = {}
        for row in rows.select(["digest", "copies", "block", "text"]).to_pylist():
            # A repeated row comes as often as it occurs.
            if row["digest"] not in members:
                members[row["digest"]] = (shingles(row["text"]), row["copies"], row["block"])
        ids = sorted(members)
        vocabulary: dict[int, int] = {}
        bits, counts = [], []
        for i in ids:
            places = [vocabulary.setdefault(h, len(vocabulary)) for h in members[i][0].tolist()]
            mask = bytearray(len(vocabulary) // 8 + 1)
            for place in places:
                mask[place >> 3] |= 1 << (place & 7)
            bits.append(int.from_bytes(mask, "little"))
            counts.append(len(places))
        root, links = list(range(len(ids))), [0] * len(ids)

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for y in range(len(ids)):
            for x in range(y):
                if first != second and members[ids[x]][2] == members[ids[y]][2]:
                    continue
                small, large = sorted((counts[x], counts[y]))
                if small < similarity * large:
                    continue
                shared = (bits[x] & bits[y]).bit_count()
                if shared >= similarity * (small + large - shared):
                    links[x] += members[ids[y]][1]
                    links[y] += members[ids[x]][1]
                    low, high = sorted((top(x), top(y)))
                    root[high] = low
        return pa.table({"digest": pa.array(ids, pa.binary()),
                         "root": pa.array([ids[top(x)] for x in range(len(ids))], pa.binary()),
                         "links": pa.array(links, pa.int64())})

    return with_text.groupBy("family", "first", "second").applyInArrow(
        compare, "digest binary, root binary, links long")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    similarity: float = SIMILARITY, target: float = RECALL) -> DataFrame:
    """Columns doc_id, text_md5, class_id, class_key (as class_id, but never null) and n_links; a
    row for each document.

    ``class_id`` is the smallest id among the documents joined by links; ``n_links`` counts the other
    documents whose similarity is at least ``similarity``, copies included.
    """
    sets = written(text_sets(docs, doc_id, text), "sets")
    texts = written(distinct_sets(sets), "texts")
    families = candidate_families(texts, target, similarity).join(
        texts.drop("signature"), "digest")
    checked = written(verified(families, docs, similarity, doc_id, text), "checked")
    classes = components(checked.filter("digest <> root").select(
        F.col("digest").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "digest")
    links = checked.groupBy("digest").agg(F.sum("links").alias("links"))
    judged = written(texts.select("digest", "no_id", "id", "copies").join(
        classes, "digest", "left").join(links, "digest", "left").select(
        "digest", F.when(~F.col("no_id"), F.col("id")).alias("id"),
        F.coalesce("class", "digest").alias("class_key"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "judged")
    least = judged.groupBy("class_key").agg(F.min("id").alias("class_id"))
    named = judged.join(least, "class_key").select("digest", "class_key", "class_id", "n_links")
    return sets.select("doc_id", "text_md5", "digest").join(named, "digest").select(
        "doc_id", "text_md5", "class_id", "class_key", "n_links")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    similarity: float = SIMILARITY, target: float = RECALL) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns; of repeated
    rows of that document any one."""
    ids = F.coalesce(F.col("doc_id"), F.lit(0).cast("long")).alias("id")
    classes = jaccard_classes(docs, doc_id, text, similarity, target).select(
        "class_key", F.col("doc_id").isNull().alias("no_id"), ids, "text_md5")
    counted = classes.groupBy("class_key", *_ROW).agg(F.count("*").alias("rows"))
    chosen = written(counted.groupBy("class_key").agg(
        F.min(F.struct(*_ROW, "rows")).alias("first")).select("first.*"), "chosen")
    repeated = written(chosen.filter("rows > 1"), "repeated")
    named = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")).select(
        "row", F.col(f"row.{doc_id}").isNull().alias("no_id"),
        F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(0).cast("long")).alias("id"),
        F.unhex(F.md5(F.coalesce(F.col(f"row.{text}"), F.lit("")).cast("binary"))).alias("text_md5"))
    once = named.join(chosen.filter("rows = 1"), _ROW, "left_semi")
    several = named.join(repeated, _ROW, "left_semi").dropDuplicates(_ROW)
    return once.unionByName(several).select("row.*")
