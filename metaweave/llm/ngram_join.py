"""N-gram Jaccard self-join by chosen paths: documents whose word-shingle sets are similar, and their classes.

A document's set holds its runs of five lower-cased words (all words, if fewer).  Equal sets
are merged first and carried as one set with a number of copies.

* Every set gets ``COORDINATES`` sampled tokens (the shingle that is smallest under the i-th
  hash function).  A node of the recursion is a path of sampled tokens; each node picks
  ``BRANCHES`` coordinates by a hash of its path, and every set in it goes on to one child for
  each, named by the token it has there.  Two sets of similarity s share a sampled token with
  probability s, so at least one of their paths survives any depth with probability
  ``q = (2s - 1) / s**2`` or more.  All runs share the sampled tokens, of which s is a binomial share, so
  ``runs_for`` sums the loss over all shares; as many runs as the target recall needs.
* All sets descend ``FIRST_DEPTH`` levels at once.  Nodes of one set end, nodes of at most
  ``SMALL`` sets are compared pair by pair.  In larger ones ``PIVOT_ROUNDS`` rounds compare every set with
  the node's smallest one only: Jaccard distance is a metric, so a set at most ``SETTLED`` from that pivot has all
  its partners at most that and the threshold's distance from it, and leaves the node once all of those are
  linked to the pivot; a group of near copies is settled in a round or two, however large.  What is left is split again, and at
  ``LAST_DEPTH`` dealt into blocks and compared block against block, so nothing is capped or dropped.
  Comparisons ask for so many equal sampled tokens that this costs half of the allowed loss at most
  (``agreement``), and leave a spanning forest of each node, never its pairs.
* The forests' connected components are the candidate groups.  Inside each, all sets are
  compared exactly (block against block where a group is large), links are counted where they are
  found, and again only a spanning forest goes on.  Its components are the classes.  Only texts that may be in a
  group go through the exchange that fetches them: a bitmap of fixed size holds the wanted ids.

Defined results, one row per input row: ``class_id`` is the smallest document id of the class,
``n_links`` the number of other documents (copies included) at or above the threshold and
``n_text_links`` the number of other sets.  A null, empty or wordless text is a class of its own
without links.  A row without an id keeps null ``class_id`` and has no links.  Rows that repeat
an id and text are copies.  Sets are told apart by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaweave.llm.common import connected_components, maybe_among, sorted_groups, written
from metaweave.llm.tokens import Tokenizer, chunks, mix, starts_within, utf8, windows

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
COORDINATES = 64
BRANCHES = 2
FIRST_DEPTH = 2
LAST_DEPTH = 5
SMALL = 64
PIVOT_ROUNDS = 2
SETTLED = 0.3
BLOCK_SETS = 192
BLOCK_SHINGLES = 200_000

_COORDINATE_SEED = 0xA0761D6478BD642F


def _share(threshold: float) -> list[float]:
    """The probability of each number of sampled tokens that a pair at the threshold shares."""
    return [math.comb(COORDINATES, k) * threshold**k * (1 - threshold)**(COORDINATES - k) for k in range(COORDINATES + 1)]


def agreement(recall: float, threshold: float) -> int:
    """Sampled tokens two sets must share to be verified; a pair at the threshold misses it in half of the allowed losses at most."""
    below, share = 0.0, _share(threshold)
    for need in range(COORDINATES + 1):
        below += share[need]
        if below > (1 - recall) / 2:
            return need
    return COORDINATES


def loss(runs: int, need: int, threshold: float) -> float:
    """The probability that a pair at the threshold shares less than ``need`` sampled tokens or no path in any run, at most."""
    share = _share(threshold)
    met = 0.0
    for k in range(need, COORDINATES + 1):
        s = k / COORDINATES
        met += share[k] * (1 - (1 - max(0.0, 2 * s - 1) / s**2)**runs if s else 0.0)
    return 1 - met


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold was met and sent to be verified with probability ``recall``."""
    need, runs = agreement(recall, threshold), 1
    while runs < COORDINATES and loss(runs, need, threshold) > 1 - recall + 1e-12:
        runs += 1
    return runs


def shingles(tokenizer: Tokenizer, data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The set of hashed shingles of each text of a chunk, sorted; empty without words."""
    _, _, _, hashes, first = tokenizer.words(data, offsets)
    whole = windows(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a:b - size + 1]))
        else:
            out.append(windows(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def set_key(own: np.ndarray) -> int:
    """A hash of the whole set, as a signed 64-bit integer."""
    return int(mix(np.array([mix(own ^ np.uint64(_COORDINATE_SEED)).sum() + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(_COORDINATE_SEED)) | np.uint64(1)


def _sketches(size: int):
    """``mapInArrow``: id, text and its hash to id, hash, set key, number of shingles and sampled tokens (32 bits each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, by = Tokenizer(), _multipliers()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets):
                sets = shingles(tokenizer, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                tokens = np.zeros((len(full), COORDINATES), np.uint32)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    begin = np.concatenate(([0], np.cumsum(n[full])[:-1]))
                    for j, m in enumerate(by):
                        tokens[:, j] = np.minimum.reduceat(((flat * m) >> np.uint64(32)).astype(np.uint32), begin)
                keys: list = [None] * len(sets)
                sketch: list = [None] * len(sets)
                for k, i in enumerate(full.tolist()):
                    keys[i], sketch[i] = set_key(sets[i]), tokens[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(keys, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(sketch, pa.binary())],
                    names=["doc_id", "text_hash", "set_id", "n_shingles", "sketch"])
    return run


def _tokens(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def _descend(path: np.ndarray, tokens: np.ndarray, row: np.ndarray):
    """Children of nodes: for each node its ``BRANCHES`` chosen coordinates; returns paths and rows."""
    paths, rows = [], []
    first = mix(path ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(COORDINATES)
    step = np.uint64(1) + mix(path ^ np.uint64(0x9FB21C651E98DF25)) % np.uint64(COORDINATES // BRANCHES - 1)
    for k in range(BRANCHES):
        at = (first + np.uint64(k) * step) % np.uint64(COORDINATES)
        token = tokens[row, at.astype(np.int64)].astype(np.uint64)
        paths.append(mix(path * np.uint64(0x9E3779B97F4A7C15) + (at << np.uint64(32)) + token))
        rows.append(row)
    return np.concatenate(paths), np.concatenate(rows)


def _first_nodes(runs: int, depth: int):
    """``mapInArrow``: set and sketch to its nodes at the first depth that is counted, in every run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = np.asarray(batch.column(0))
            tokens = _tokens(batch.column(1))
            for r in range(runs):
                row = np.arange(len(sets))
                path = np.full(len(sets), mix(np.array([r + 1], np.uint64))[0])
                for _ in range(depth):
                    path, row = _descend(path, tokens, row)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(sets[row])], names=["path", "set_id"])
    return run


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow``: path, set and sketch to the children."""
    for batch in batches:
        sets = np.asarray(batch.column(1))
        path, row = _descend(np.asarray(batch.column(0)).view(np.uint64), _tokens(batch.column(2)), np.arange(len(sets)))
        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(sets[row])], names=["path", "set_id"])


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the smallest row it is connected to."""
    label = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        low = np.where(linked, label[None, :], len(label)).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _compare_tokens(need: int):
    """``mapInArrow`` over nodes sorted by path: a spanning forest of the sets that share ``need`` sampled tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in sorted_groups(batches):
            if group.num_rows < 2:
                continue
            sets, tokens = np.asarray(group.column(1)), _tokens(group.column(2).combine_chunks())
            if len(sets) == 2:
                if (tokens[0] == tokens[1]).sum() >= need and sets[0] != sets[1]:
                    a.append(sets[:1]), b.append(sets[1:])
            else:
                agree = np.zeros((len(sets), len(sets)), np.int16)
                for j in range(COORDINATES):
                    agree += tokens[:, j, None] == tokens[None, :, j]
                root = _roots(agree >= need)
                other = np.flatnonzero(root != np.arange(len(sets)))
                a.append(sets[other]), b.append(sets[root[other]])
            if len(a) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
    return run


def _compare_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow``: set, pivot and both sketches to the number of sampled tokens that agree."""
    for batch in batches:
        agree = (_tokens(batch.column(2)) == _tokens(batch.column(3))).sum(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(agree.astype(np.int32))], names=["set_id", "pivot", "agree"])


def _pivot_rounds(large: DataFrame, sets: DataFrame, need: int) -> tuple[DataFrame | None, list[DataFrame]]:
    """What is left of large nodes after the rounds, and the links to pivots that were found.

    A partner of a settled set differs from the pivot in the tokens in which the two differ from the settled set, at most.
    A set meets the same pivot in several nodes, and is compared with it once; what is left of a node may be one set, which ends.
    """
    settled = math.ceil((1 - SETTLED) * COORDINATES)
    linked = max(0, need - (COORDINATES - settled))
    sketches, links, here = sets.select("set_id", "sketch"), [], W.partitionBy("path")
    for _ in range(PIVOT_ROUNDS):
        large = large.select("path", "set_id", F.min("set_id").over(here).alias("pivot"), F.max("set_id").over(here).alias("last"))
        large = written(large.where("pivot < last").drop("last"), "large-nodes")
        if large.isEmpty():
            return None, links
        pairs = large.select("set_id", "pivot").distinct()
        pivots = pairs.select("pivot").distinct().join(sketches.select(F.col("set_id").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot")
        met = pairs.join(sketches, "set_id").join(pivots, "pivot").select("set_id", "pivot", "sketch", "pivot_sketch")
        met = written(met.mapInArrow(_compare_pivot, "set_id long, pivot long, agree int"), "pivots")
        links.append(met.where((F.col("agree") >= linked) & (F.col("set_id") != F.col("pivot"))).select(
            F.col("set_id").alias("a"), F.col("pivot").alias("b")))
        large = large.join(met.where(F.col("agree") < settled), ["set_id", "pivot"], "left_semi").select("path", "set_id")
    return large, links


def _blocks(members: DataFrame, group: str, blocks: str) -> DataFrame:
    """Deals each group's sets into ``blocks`` blocks and gives every pair of blocks one row set.

    Adds ``block`` and ``task`` (one for each group and pair of blocks); a set appears in as many
    tasks as its group has blocks.
    """
    dealt = members.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col(blocks)))
    pairs = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
    return pairs.withColumn("task", F.when(F.col(blocks) == 1, F.col(group)).otherwise(
        F.xxhash64(group, F.least("block", "_other"), F.greatest("block", "_other")))).withColumn(
        "inside", F.col("block") == F.col("_other")).drop("_other")


def _by_task(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(F.col(key)).sortWithinPartitions(key)


def candidates(sets: DataFrame, runs: int, threshold: float, recall: float = RECALL) -> DataFrame:
    """Links ``a``, ``b`` (a spanning forest of every leaf) between sets that may be similar."""
    need = agreement(recall, threshold)
    nodes = sets.select("set_id", "sketch").mapInArrow(_first_nodes(runs, FIRST_DEPTH), "path long, set_id long")
    leaves, links = [], []
    for depth in range(FIRST_DEPTH, LAST_DEPTH + 1):
        # Nodes are exchanged once, as two numbers a row; those of one set are never written.
        counted = nodes.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("path")))
        shared = written(counted.where("n > 1"), "shared-nodes")
        leaves.append(shared.where(F.col("n") <= SMALL).select("path", "set_id"))
        large, found = _pivot_rounds(shared.where(F.col("n") > SMALL), sets, need)
        links += found
        if depth == LAST_DEPTH:
            if large is not None:
                blocks = F.ceil(F.count(F.lit(1)).over(W.partitionBy("path")) / BLOCK_SETS)
                leaves.append(_blocks(large.select("path", "set_id", blocks.alias("blocks")), "path", "blocks").select(F.col("task").alias("path"), "set_id").distinct())
        elif large is None:
            break
        else:
            nodes = large.select("path", "set_id").join(sets.select("set_id", "sketch"), "set_id")
            nodes = nodes.select("path", "set_id", "sketch").mapInArrow(_split, "path long, set_id long")
    met = leaves[0]
    for more in leaves[1:]:
        met = met.union(more)
    met = met.join(sets.select("set_id", "sketch"), "set_id").select("path", "set_id", "sketch")
    found = _by_task(met, "path").mapInArrow(_compare_tokens(need), "a long, b long")
    for more in links:
        found = found.union(more)
    return _thinned(found)


def _thinned(links: DataFrame) -> DataFrame:
    """Links with the same components: each set keeps one, to the smallest set it is linked to, and those it was linked to get one to that.

    A set has at most a link for each of its nodes, but a group of near copies shares its pivots, so few different links are left.
    """
    own = links.withColumn("least", F.least("a", F.min("b").over(W.partitionBy("a"))))
    both = own.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return both.where("a <> b").distinct()


def _shingle_rows(size: int):
    """``mapInArrow``: task columns and text to task columns and sorted shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            wanted = np.asarray(batch.column(0))
            for a, b in chunks(offsets):
                own = shingles(tokenizer, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size)
                keep = [i for i, s in enumerate(own) if len(s) and set_key(s) == wanted[a + i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted[a:b][keep], pa.int64()), pa.array([own[i].tobytes() for i in keep], pa.binary())],
                    names=["set_id", "shingles"])
    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Number of shared shingles of every pair of sets."""
    if len(sets) == 2:
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.concatenate(([0], np.cumsum(flat[1:] != flat[:-1])))
    several = np.bincount(column)[column] > 1
    column, owner = column[several], owner[several]
    out = np.zeros((len(sets), len(sets)), np.int64)
    if len(column):
        column = np.concatenate(([0], np.cumsum(column[1:] != column[:-1])))
        width = 4096
        edges = np.searchsorted(column, np.arange(0, column[-1] + width + 1, width))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a:
                dense = np.zeros((len(sets), width), np.float32)
                dense[owner[a:b], column[a:b] - k * width] = 1
                out += (dense @ dense.T).astype(np.int64)
    return out


def _verify(threshold: float):
    """``mapInArrow`` over tasks: each set's links found in the task, and a set it is connected to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches):
            ids, at = np.unique(np.asarray(group.column("set_id")), return_index=True)
            if len(ids) < 2:
                continue
            raw = group.column("shingles").combine_chunks().take(pa.array(at)).to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in raw]
            copies, block = np.asarray(group.column("copies"))[at], np.asarray(group.column("block"))[at]
            inside = bool(group.column("inside")[0].as_py())
            n = np.array([len(s) for s in sets], np.float64)
            common = _common(sets).astype(np.float64)
            linked = common >= threshold * (n[:, None] + n[None, :] - common) - 1e-9
            np.fill_diagonal(linked, False)
            if not inside:  # pairs within a block belong to that block's own task
                linked &= block[:, None] != block[None, :]
            some = np.flatnonzero(linked.any(axis=1))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array((linked @ copies)[some].astype(np.int64)), pa.array(linked.sum(axis=1)[some].astype(np.int64)),
                     pa.array(ids[_roots(linked)[some]])], names=["set_id", "links", "texts", "root"])
    return run


def join_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS,
                 threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``doc_id``, ``class_id``, ``n_links``, ``n_text_links``, and hashes of its set, class and text, for every row of ``docs``."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = given.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _sketches(size), "doc_id long, text_hash long, set_id long, n_shingles long, sketch binary")
    rows = written(rows, "sketches")
    sets = written(rows.where("doc_id IS NOT NULL AND set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")), "sets")
    groups = connected_components(candidates(sets, runs_for(recall, threshold), threshold, recall))

    member = groups.select(F.col("node").alias("set_id"), F.col("component").alias("candidate")).join(sets.drop("sketch"), "set_id")
    member = written(member, "candidates")
    blocks = member.groupBy("candidate").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    wanted = member.select("set_id", F.col("first_id").alias("doc_id"))
    texts = maybe_among(given, "doc_id", wanted, "doc_id").join(wanted, "doc_id").select("set_id", "text")
    texts = texts.mapInArrow(_shingle_rows(size), "set_id long, shingles binary")
    tasks = _blocks(member.select("set_id", "candidate", "copies").join(blocks, "candidate"), "candidate", "blocks")
    tasks = tasks.select("task", "block", "inside", "set_id", "copies").join(texts, "set_id")
    tasks = tasks.select("task", "block", "inside", "set_id", "copies", "shingles")
    found = written(_by_task(tasks, "task").mapInArrow(_verify(threshold), "set_id long, links long, texts long, root long"), "links")

    links = found.groupBy("set_id").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    classes = connected_components(found, "set_id", "root").select(F.col("node").alias("set_id"), F.col("component").alias("class"))
    named = sets.select("set_id", "first_id", "copies").join(classes, "set_id", "left").join(links, "set_id", "left")
    named = named.withColumn("class", F.coalesce("class", "set_id"))
    smallest = named.groupBy("class").agg(F.min("first_id").alias("class_id"))
    named = named.join(smallest, "class").select(
        "set_id", F.col("class").alias("class_set"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    joined = rows.select("doc_id", "set_id", "text_hash").join(named, "set_id", "left")
    has = F.col("doc_id").isNotNull()
    return joined.select(
        "doc_id", F.when(has, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(has, F.coalesce("n_text_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_text_links"), "set_id", "class_set", "text_hash")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each class; of rows that repeat it, one with the class's text.

    An id may stand for several texts: each row goes or stays by its own text.  Of rows with the smallest id whose texts are in
    the class, the one with the smallest hash of its text stays.  Rows without an id are kept.
    """
    joined = join_classes(docs, doc_id, text, **options).where("doc_id = class_id")
    # A text without words has no set and is a class of its own, together with rows that repeat its id.
    own = joined.groupBy("doc_id", F.coalesce("class_set", "text_hash").alias("_class")).agg(F.min("text_hash").alias("_hash"))
    first = own.select(F.col("doc_id").alias("_kept"), "_hash")
    hashed = docs.withColumn("_text", F.xxhash64(text))
    left = hashed.where(F.col(doc_id).isNotNull()).join(
        first, (F.col(doc_id) == F.col("_kept")) & (F.col("_text") == F.col("_hash")), "left_semi")
    left = left.dropDuplicates([doc_id, "_text"])
    return left.unionByName(hashed.where(F.col(doc_id).isNull())).drop("_text")


def brute_force(docs: list[tuple[int, str | None]], size: int = WORDS, threshold: float = THRESHOLD) -> dict[int, tuple[int, int]]:
    """``{doc_id: (class_id, n_links)}`` by comparing all pairs; for tests with unique ids."""
    import re

    sets = {}
    for doc, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        sets[doc] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    near: dict[int, set[int]] = {d: set() for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) >= threshold * max(len(x), len(y)) - 1e-9 and len(x & y) >= threshold * len(x | y) - 1e-9:
                near[a].add(b), near[b].add(a)
    out: dict[int, tuple[int, int]] = {}
    for d in ids:
        if d not in out:
            seen, todo = {d}, [d]
            while todo:
                for m in near[todo.pop()] - seen:
                    seen.add(m), todo.append(m)
            for m in seen:
                out[m] = (min(seen), len(near[m]))
    return out
