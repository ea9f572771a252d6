"""Merkle manifest against a plain-Python tree: superblocks of four leaves, odd rows, many languages, tampering."""

import hashlib

import pytest
from pyspark.sql import functions as F

from metaweave.llm import merkle_manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))


def climb(nodes):
    """Root and, for each node, its siblings (side, digest) or None, leaf to root."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for w, i in zip(ways, at, strict=True):
            w.append(("L", nodes[i - 1]) if i % 2 else ("R", nodes[i + 1]) if i + 1 < len(nodes) else None)
        nodes, at = [h("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return nodes[0], ways


def fold(d, way):
    for step in way:
        d = h(d) if step is None else h(step[1] + d) if step[0] == "L" else h(d + step[1])
    return d


def brute_force(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {g: sorted(((r[0] is not None, r[0] or 0, leaf(r)) for r in trees[g])) for g in order}
    lows = {g: climb([x[2] for x in built[g]]) for g in order}
    root, tops = climb([lows[g][0] for g in order])
    out = []
    for g, top in zip(order, tops, strict=True):
        for (known, i, d), way in zip(built[g], lows[g][1], strict=True):
            whole = way + top
            out.append((i if known else None, d, lows[g][0], root, h("".join(s[1] for s in whole if s)), fold(d, whole)))
    return out


def result(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.digest, r.folded_root) for r in df.withColumn("digest", M.siblings_digest(F.col("proof"))).collect()]


def same(got, want):
    return sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("n, langs, bits", [(1, 1, 2), (2, 1, 2), (5, 1, 2), (16, 1, 2), (17, 1, 2), (70, 3, 2), (40, 40, 2), (300, 7, 3)])
def test_trees_of_every_shape(spark, n, langs, bits):
    rows = [(i * 3 % 1009, f"text {i}", f"l{i % langs}", "s", i) for i in range(n)]
    got = result(M.manifest(spark.createDataFrame(rows, SCHEMA), bits=bits))
    assert same(got, brute_force(rows)) and all(r[5] == r[3] for r in got)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in odd_docs.collect()]
    big = [(2**62 + 1, "x", None, None, None), (-5, "ÿ😀", "é", "", -1)]
    df = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(big, SCHEMA))
    assert same(result(M.manifest(df, bits=1)), brute_force(rows + big))
    assert M.manifest(odd_docs).count() == len(rows)
    assert M.manifest(no_docs).count() == 0


def test_tampering_is_seen_where_it_happened(spark, docs):
    df = docs([f"text {i}" for i in range(50)])
    forged = F.when(F.col("doc_id") % 9 == 0, M.leaf_digest(df, n_chars=F.col("n_chars") + 1))
    got = {r.doc_id: r.folded_root == r.root for r in M.manifest(df, forged, bits=3).collect()}
    assert got == {i: i % 9 != 0 for i in range(50)}
