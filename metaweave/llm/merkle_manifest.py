"""Merkle manifest of a dataset: a tree per language over its documents, a root over the languages, a proof per document.

A leaf is the SHA-256 of a document's fields.  Leaves of a language stand in ascending order of ``doc_id``; every two
neighbours become the digest of their hexadecimal digests, a last lone one its own digest's, until one is left.

* **Leaves.**  Hashed where the rows are read; texts never move.  Only ids and digests are numbered in their language, by
  ranges of the whole order (``functions.ordered.range_ordinal``), so a hot language is shared by many tasks.
* **Upwards.**  ``2**bits`` neighbouring leaves are a superblock, reduced to one node by one task; the nodes that come out
  are reduced in superblocks again until each tree has its root.  The languages' roots make up one more tree.
* **Downwards.**  For each level of superblocks the nodes and the outer nodes that their proofs need (one row a
  superblock: siblings above it, subroot and root) are cogrouped by superblock.  There the local reduction is finished,
  local siblings are joined with the outer ones, and, at the leaves, each proof is folded back into a root.

A group never holds more than ``2**bits`` nodes and one row of ``log2(rows)`` outer digests; the number of rounds grows
with the logarithm of the rows.  The driver sees two counts.

Null ids come first in their language, equal ids stand in the order of their leaves; equal rows have equal leaves, each with
a proof of its own place.  Null languages are a language of their own, ordered first.  Null fields count as ``-``; empty and
very long texts are hashed whole.  An empty table gives no rows.  Further columns take no part and are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaweave.functions.ordered import range_ordinal
from metaweave.functions.sizing import broadcast_if_small
from metaweave.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a superblock, as a power of two.
BITS = 10


def field_bytes(value: Column, kind: str) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value if kind == "string" else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, **instead: Column) -> Column:
    """Binary SHA-256 of the document's fields; ``instead`` replaces some of them."""
    kinds = dict(docs.dtypes)
    parts = [field_bytes(instead.get(c, F.col(c)), kinds[c]) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _parent(pair: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in pair).encode()).digest()


def _levels(nodes: list[bytes], tall: bool, bits: int) -> Iterator[list[bytes]]:
    """The levels of a superblock, ``nodes`` first: ``bits`` steps up in a tree that goes on above it, else until one is left."""
    yield nodes
    step = 0
    while step < bits if tall else len(nodes) > 1:
        nodes = [_parent(nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        step += 1
        yield nodes


def _sibling(level: list[bytes], at: int) -> bytes:
    """Left (``L``) or right (``R``) sibling with its digest; a lone node has none (``-``)."""
    if at % 2:
        return b"L" + level[at - 1]
    return b"R" + level[at + 1] if at + 1 < len(level) else b"-"


def _fold(digest: bytes, steps: list[bytes]) -> bytes:
    for s in steps:
        digest = _parent([s[1:], digest] if s[:1] == b"L" else [digest, s[1:]] if s[:1] == b"R" else [digest])
    return digest


def reduce_superblocks(nodes: DataFrame, bits: int) -> DataFrame:
    """``(tree, n, at, digest)`` one superblock level up; ``n`` is the number of nodes of the tree on its level."""
    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        n = int(block["n"].iloc[0])
        *_, top = _levels(block["digest"].tolist(), n > 1 << bits, bits)
        return pd.DataFrame({"tree": [block["tree"].iloc[0]], "n": [((n - 1) >> bits) + 1], "at": [int(block["at"].iloc[0]) >> bits], "digest": top})

    return nodes.select("tree", "n", "at", "digest").groupBy("tree", F.shiftright("at", bits).alias("block")).applyInPandas(
        reduce, "tree long, n long, at long, digest binary")


def descend(nodes: DataFrame, outer: DataFrame, bits: int) -> DataFrame:
    """``(tree, at, path, subroot, root)``: the siblings of each node up to the root.

    ``outer`` has the same columns for the superblocks of ``nodes`` (``at`` is the superblock's number).
    """
    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, paths = _local_paths(block, above, bits)
        return pd.DataFrame({"tree": block["tree"], "at": block["at"], "path": paths,
                             "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})

    return _cogrouped(nodes, outer, bits, join, "tree long, at long, path array<binary>, subroot binary, root binary")


def _local_paths(block: pd.DataFrame, above: pd.DataFrame, bits: int) -> tuple[pd.DataFrame, list[list[bytes]]]:
    block = block.sort_values("at")
    levels = list(_levels(block["digest"].tolist(), int(block["n"].iloc[0]) > 1 << bits, bits))
    outer = list(above["path"].iloc[0])
    return block, [[_sibling(level, i >> k) for k, level in enumerate(levels[:-1])] + outer for i in range(len(block))]


def _cogrouped(nodes: DataFrame, outer: DataFrame, bits: int, function, schema: str) -> DataFrame:
    left = nodes.withColumn("block", F.shiftright("at", bits)).groupBy("tree", "block")
    right = outer.withColumnRenamed("at", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(function, schema)


def _prove(leaves: DataFrame, outer: DataFrame, bits: int) -> DataFrame:
    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, paths = _local_paths(block, above, bits)
        root, subroot = above["root"].iloc[0], above["subroot"].iloc[0]
        shown = [d if f is None else f for d, f in zip(block["digest"], block["forged"], strict=True)]
        folded = [_fold(d, p) for d, p in zip(shown, paths, strict=True)]
        return pd.DataFrame({
            "doc_id": block["doc_id"], "leaf": [d.hex() for d in block["digest"]], "subroot": subroot.hex(), "root": root.hex(),
            "proof": [[(s[:1].decode() + s[1:].hex()) for s in p] for p in paths], "folded_root": [f.hex() for f in folded]})

    return _cogrouped(leaves, outer, bits, join, "doc_id string, leaf string, subroot string, root string, proof array<string>, folded_root string")


def siblings_digest(proof: Column) -> Column:
    """SHA-256 in hex of a proof's sibling digests, leaf to root, in hex and concatenated."""
    digests = F.transform(F.filter(proof, lambda p: p != "-"), lambda p: F.substr(p, F.lit(2)))
    return F.sha2(F.array_join(digests, ""), 256)


def _tree(nodes: DataFrame, n: int, bits: int) -> list[DataFrame]:
    """``nodes`` and the nodes of every superblock level above them, each written, up to one node a tree.

    ``n`` is the largest number of nodes of a tree.
    """
    levels = [nodes]
    while n > 1:
        levels.append(written(reduce_superblocks(levels[-1], bits), "merkle-nodes"))
        n = ((n - 1) >> bits) + 1
    return levels


def manifest(docs: DataFrame, forged: Column | None = None, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root`` (digests in hex).

    ``proof`` lists the way from leaf to root: ``L`` or ``R`` and the sibling's digest, ``-`` where the node stands alone.
    ``folded_root`` is what the proof gives for ``forged``, a binary leaf to be shown in place of the true one, where that
    is not null, else for the leaf itself; it equals ``root`` exactly for untampered rows.
    """
    forged = F.lit(None).cast("binary") if forged is None else forged
    leaves = written(docs.select("lang", "doc_id", leaf_digest(docs).alias("digest"), forged.alias("forged")), "merkle-leaves")
    # Languages in bytewise order, null first; there may be very many of them.
    langs = written(leaves.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "merkle-langs")
    langs = written(range_ordinal(langs, [], ["lang"], "tree"), "merkle-langs")
    size = langs.agg(F.count(F.lit(1)).alias("langs"), F.max("n").alias("most")).first()
    placed = range_ordinal(leaves, ["lang"], ["doc_id", "digest"], "at")
    of_lang = broadcast_if_small(langs.select(F.col("lang").alias("_lang"), "tree", "n"))
    placed = placed.join(of_lang, F.col("lang").eqNullSafe(F.col("_lang"))).drop("lang", "_lang")
    placed = written(placed.withColumn("doc_id", F.col("doc_id").cast("string")), "merkle-leaves")  # exact in pandas, null or not

    trees = _tree(placed, size["most"] or 0, bits)
    subroots = trees[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(size["langs"]).cast("long").alias("n"), F.col("tree").alias("at"), "digest")
    tops = _tree(subroots, size["langs"], bits)

    # From the root down: the root's own path is empty.
    bare = F.array().cast("array<binary>")
    outer = tops[-1].select("tree", "at", bare.alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    for level in tops[-2::-1]:
        outer = written(descend(level, outer, bits), "merkle-outer")
    above = outer.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "path", "root")
    outer = trees[-1].select("tree", F.col("digest").alias("subroot")).join(above, "tree")
    outer = written(outer.select("tree", "at", "path", "subroot", "root"), "merkle-outer")
    for level in trees[-2:0:-1]:
        outer = written(descend(level, outer, bits), "merkle-outer")
    kind = dict(docs.dtypes)["doc_id"]
    return _prove(placed, outer, bits).withColumn("doc_id", F.col("doc_id").cast(kind))
