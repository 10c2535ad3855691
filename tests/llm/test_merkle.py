"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewarden.llm import merkle
from tidewarden.llm.queries import manifest_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (doc_id, source, lang, n_chars, text)))


def plain_root(nodes, at):
    """The root and the siblings of a place, with their side."""
    path = []
    while len(nodes) > 1:
        pair = nodes[at // 2 * 2:at // 2 * 2 + 2]
        path.append((at % 2, pair[1 - at % 2] if len(pair) == 2 else None))
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        at //= 2
    return nodes[0], path


def plain(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = plain_leaf(doc_id, source, lang, n_chars, text)
        tampered = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        changed = plain_leaf(doc_id, source, lang, n_chars + 1, text) if tampered else leaf
        trees.setdefault((lang is not None, (lang or "").encode()), []).append(
            ((doc_id is not None, doc_id or 0), leaf, changed))
    names = sorted(trees)
    subroots = [plain_root([n[1] for n in sorted(trees[k])], 0)[0] for k in names]
    result = []
    for i, name in enumerate(names):
        leaves = sorted(trees[name])
        root, upper = plain_root(subroots, i)
        for at, ((known, doc_id), leaf, changed) in enumerate(leaves):
            subroot, path = plain_root([n[1] for n in leaves], at)
            folded = changed
            for second, other in path + upper:
                folded = sha(folded if other is None else other + folded if second else folded + other)
            result.append((doc_id if known else None, leaf, subroot, root,
                           sha("".join(o for _, o in path + upper if o)), folded, folded == root))
    return result


def documents(count, langs, seed=1):
    chance = random.Random(seed)
    return [(i, chance.choice(["", None, "Zażółć", "a" * chance.randrange(50)]), chance.choice(langs),
             chance.choice([None, "s"]), chance.choice([None, 3, 99]), "clash", 7)
            for i in chance.sample(range(10 * count), count)]


def found(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in manifest_rows(frame).select(columns).collect()]


@pytest.mark.parametrize("rows", [
    documents(1, ["en"]), documents(2, ["en"]), documents(3, ["en"]),
    documents(90, ["en", None, "", "é", "zz"]),
    [*documents(20, [None, "x"]), (None, None, None, None, None, None, None),
     *[(5, t, "x", "s", 1, "", 0) for t in ("p", "q", "p")], (8, "w " * 200000, "long", "s", 2, "", 0)],
], ids=["one", "two", "three", "langs", "odd"])
def test_rows_match_a_plain_tree(spark, rows):
    assert sorted(found(spark, rows), key=str) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_blocks_of_any_size_give_the_same_tree(spark, bits):
    rows = documents(45, ["a", "a", "a", "b", "c", None, "d", "e", "f"])
    leaves = merkle.document_leaves(spark.createDataFrame(rows, SCHEMA),
                                    F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    tree = merkle.build(leaves, bits)
    assert tree.select(F.max(F.size("nodes"))).first()[0] <= 1 << bits
    got = [(r.id, r.leaf, r.subroot, r.root, sha("".join(r.proof)), r.folded_root, r.verified)
           for r in merkle.verify(tree, bits).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert any(not r[-1] for r in got)
    # Versions end in the same roots, whatever the blocks.
    tops = {max((r.level, r.digest) for r in merkle.copied_nodes(tree, bits).collect()
                if (r.tree, r.version) == key)[1]
            for key in {(r.tree, r.version) for r in merkle.copied_nodes(tree, bits).collect()}}
    assert tops == {r[5] for r in got if not r[-1]}


def test_large_tree_over_several_steps(spark):
    rows = [(i, str(i), "en" if i % 50 else "de", "s", i, "", 0) for i in range(5000)]
    assert sorted(found(spark, rows), key=str) == sorted(plain(rows), key=str)


def test_versions_copy_only_their_path(spark):
    rows = documents(300, ["en", "de", "fr"])
    frame = spark.createDataFrame(rows, SCHEMA)
    leaves = merkle.document_leaves(frame, F.col("doc_id") % 3 == 0)
    tree = merkle.build(leaves)
    copied = merkle.copied_nodes(tree).collect()
    changed = leaves.filter("changed <> digest").count()
    tops = {}
    for r in copied:
        tops.setdefault((r.tree, r.version), []).append((r.level, r.digest))
    assert len(tops) == changed
    folded = {r.folded_root for r in merkle.verify(tree).collect() if not r.verified}
    assert {max(v)[1] for v in tops.values()} == folded
    sizes = dict(leaves.groupBy("tree").count().collect())
    for (name, _), nodes in tops.items():
        assert len(nodes) == 1 + merkle.height(sizes[name]) + merkle.height(len(sizes))


def test_empty_table(spark):
    assert found(spark, []) == []
