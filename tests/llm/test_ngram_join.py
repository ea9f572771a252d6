import math
import random

import numpy as np
import pytest
from conftest import prose

from metaweave.llm import common
from metaweave.llm import ngram_join as N


def classes(df, **kw):
    return {r.doc_id: (r.class_id, r.n_links) for r in N.join_classes(df, **kw).collect()}


def variants(base, n, seed, edits):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"odd{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_against_brute_force(docs):
    texts = [prose(80, i) for i in range(30)]
    for i in range(6):
        texts += variants(texts[i], 4, i, i)
    texts += [texts[0], texts[0].upper(), "one two three", "One, two; three!", "one two", "", None, "..."]
    want = N.brute_force(list(enumerate(texts)))
    assert classes(docs(texts)) == want and sum(n > 0 for _, n in want.values()) > 15


def test_a_large_group_of_near_copies(docs, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 8)
    monkeypatch.setattr(N, "BLOCK_SETS", 16)
    base = prose(200, 9)
    texts = [base, *variants(base, 120, 3, 2), *[prose(60, 50 + i) for i in range(20)]]
    want = N.brute_force(list(enumerate(texts)))
    got = classes(docs(texts))
    assert {d: c for d, (c, _) in got.items()} == {d: c for d, (c, _) in want.items()}
    assert got == want


def test_recall_at_the_threshold():
    """Pairs right at the threshold share a node of the first depth in one of the runs, as often as promised."""
    rng = np.random.default_rng(1)
    pairs, met = 400, 0
    tokens = rng.integers(1 << 32, size=(2 * pairs, N.COORDINATES), dtype=np.uint64).astype(np.uint32)
    agree = rng.random((pairs, N.COORDINATES)) < N.THRESHOLD
    tokens[1::2][agree] = tokens[::2][agree]
    shared = np.zeros(pairs, bool)
    for r in range(N.runs_for(N.RECALL, N.THRESHOLD)):
        row = np.arange(2 * pairs)
        path = np.full(2 * pairs, N.mix(np.array([r + 1], np.uint64))[0])
        for _ in range(N.LAST_DEPTH):
            path, row = N._descend(path, tokens, row)
        nodes = [set() for _ in range(2 * pairs)]
        for p, i in zip(path.tolist(), row.tolist(), strict=True):
            nodes[i].add(p)
        shared |= np.array([bool(nodes[2 * k] & nodes[2 * k + 1]) for k in range(pairs)])
    met = shared.mean()
    assert met >= 0.99


def test_recall_of_candidates_at_the_threshold(spark):
    """Isolated pairs right at the threshold come out of the whole candidate search, token comparison included."""
    rng = np.random.default_rng(2)
    pairs = 10_000
    tokens = rng.integers(1 << 32, size=(2 * pairs, N.COORDINATES), dtype=np.uint64).astype(np.uint32)
    agree = rng.random((pairs, N.COORDINATES)) < N.THRESHOLD
    tokens[1::2][agree] = tokens[::2][agree]
    sets = spark.createDataFrame([(i, bytearray(t.tobytes())) for i, t in enumerate(tokens)], "set_id long, sketch binary")
    found = N.candidates(sets, N.runs_for(N.RECALL, N.THRESHOLD), N.THRESHOLD).collect()
    met = {r.a // 2 for r in found if r.a // 2 == r.b // 2}
    assert len(met) >= 0.998 * pairs
    assert N.loss(N.runs_for(N.RECALL, N.THRESHOLD), N.agreement(N.RECALL, N.THRESHOLD), N.THRESHOLD) <= 1 - N.RECALL


def test_partners_of_a_settled_set_are_linked_to_the_pivot(spark):
    """Set 1 is as far from the pivot 0 as a settled set may be, set 2 as far from set 1 as a partner may be."""
    need, far = N.agreement(N.RECALL, N.THRESHOLD), N.COORDINATES - math.ceil((1 - N.SETTLED) * N.COORDINATES)
    tokens = np.zeros((3, N.COORDINATES), np.uint32)
    tokens[1, :far] = 1
    tokens[2, :far + N.COORDINATES - need] = 1
    sets = spark.createDataFrame([(i, bytearray(t.tobytes())) for i, t in enumerate(tokens)], "set_id long, sketch binary")
    large = spark.createDataFrame([(7, i) for i in range(3)], "path long, set_id long")
    _, links = N._pivot_rounds(large, sets, need)
    assert {(r.a, r.b) for r in links[0].collect()} == {(1, 0), (2, 0)}


def test_keep_one(docs, odd_docs, no_docs):
    base = prose(60, 1)
    kept = N.keep_one(docs([base, base, variants(base, 1, 1, 1)[0], prose(60, 2), None, ""])).collect()
    assert sorted(r.doc_id for r in kept) == [0, 3, 4, 5]
    out = N.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 2
    assert N.keep_one(no_docs).count() == 0


def test_keep_one_of_ids_with_several_texts(spark):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    near = variants(a, 1, 1, 1)[0]
    df = spark.createDataFrame([(3, a), (5, b), (5, a), (7, c), (7, near), (8, c), (9, None), (9, ""), (9, "")], "doc_id long, text string")
    kept = sorted((r.doc_id, r.text or str(r.text)) for r in N.keep_one(df).collect())
    assert kept == sorted([(3, a), (5, b), (7, c), (9, "None"), (9, "")])


def test_thinned_links_keep_components(spark):
    rng = random.Random(4)
    links = [(a, b) for a in range(400) for b in rng.sample(range(400), rng.choice([0, 0, 1, 1, 3])) if a != b]
    df = spark.createDataFrame(links, "a long, b long")
    thin = N._thinned(df)
    assert thin.count() <= len(set(links))
    def components(edges):
        return {(r.node, r.component) for r in common.connected_components(edges).collect()}
    assert components(thin) == components(df)


def test_maybe_among_loses_no_wanted_key(spark):
    keys = spark.range(-5000, 5000).withColumnRenamed("id", "k")
    wanted = spark.range(-5000, 5000, 7).withColumnRenamed("id", "w")
    got = {r.k for r in common.maybe_among(keys, "k", wanted, "w").collect()}
    assert set(range(-5000, 5000, 7)) <= got and len(got) < 1500
    assert {r.k for r in common.maybe_among(keys, "k", wanted, "w", bits=1 << 12).collect()} >= set(range(-5000, 5000, 7))
    assert common.maybe_among(keys, "k", wanted.limit(0), "w").count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = N.join_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.class_id, r.n_links))
    assert by[1] == [(1, 2), (1, 2)] and by[2] == [(1, 2)]
    assert by[3] == [(3, 0)] and by[4] == [(4, 0)] and by[None] == [(None, 0), (None, 0)]
    assert N.join_classes(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (None, 3)]
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            group[y] = x
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in group}


def test_sorted_groups_are_whole():
    import pyarrow as pa
    batches = [pa.RecordBatch.from_arrays([pa.array(k), pa.array(range(len(k)))], names=["k", "v"]) for k in ([1, 1, 2], [], [2, 2, 2], [2, 3])]
    assert [(g.column(0)[0].as_py(), g.num_rows) for g in common.sorted_groups(iter(batches))] == [(1, 2), (2, 5), (3, 1)]


def test_a_set_is_compared_once_with_a_pivot_of_several_nodes(spark, monkeypatch):
    tokens = np.zeros((40, N.COORDINATES), np.uint32)
    tokens[20:, :48] = np.arange(20, 40, dtype=np.uint32)[:, None]
    sets = spark.createDataFrame([(i, bytearray(t.tobytes())) for i, t in enumerate(tokens)], "set_id long, sketch binary")
    large = spark.createDataFrame([(p, i) for p in range(16) for i in range(40)], "path long, set_id long")
    rows = {}

    def counted(df, name, *a, **k):
        out = common.written(df, name, *a, **k)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(N, "written", counted)
    left, links = N._pivot_rounds(large, sets, N.agreement(N.RECALL, N.THRESHOLD))
    assert rows["pivots"] == [40, 20]
    assert {(r.a, r.b) for r in links[0].collect()} == {(i, 0) for i in range(1, 20)}
    # Sets that no pivot settled stay in every node.
    assert sorted(map(tuple, left.select("path", "set_id").collect())) == [(p, i) for p in range(16) for i in range(21, 40)]
