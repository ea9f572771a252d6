"""Benchmark decontamination: a broadcast set of normalised benchmark n-grams against all training text.

A window is ``size`` consecutive words of a benchmark item; an item of fewer words, but not
none, is one window.  Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
characters, so punctuation, spacing and line ends do not matter.  The windows' hashes are
broadcast, every window of every whole text is looked up, and each hit is verified word by
word against the benchmark's own words.

The broadcast holds benchmark windows only, never training text, and its size is bounded: tasks cut items of more
than ``PIECE_WORDS`` windows into pieces that overlap by ``size - 1`` words, and pieces are dealt into rounds of at most
``MAX_BENCHMARK_BYTES`` of text and ids each.  One round, the usual case, is one scan of the texts.  More rounds
run one after the other: each has its own broadcast, which is released before the next, and writes the hit word ranges
of the texts that have any, keyed by two hashes of the text.  These are merged for each text and joined back.

Defined results: a null or wordless text has no words and no hits; a null or wordless item has
no window; an empty benchmark hits nothing; repeated items count once; an item without an id
marks words but is not counted; rows, repeated ids and extra columns pass through, and input
columns named like an output column are renamed ``in_<name>``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaweave.llm.common import free_names, written
from metaweave.llm.tokens import Tokenizer, chunks, starts_within, utf8, windows

SIZE = 10
#: Benchmark text and ids whose windows are broadcast at once; in a worker they take about six times that.
MAX_BENCHMARK_BYTES = 8 << 20
#: Windows of a piece of a benchmark item.
PIECE_WORDS = 4096

OUT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


@dataclass
class WindowSet:
    """Windows of benchmark pieces in flat arrays: the pieces' words, whose piece a word is, and windows by length."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    ids: list[str | None]
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]  # hashes in order, and the first word of each

    def words(self, i: int, length: int) -> bytes:
        return _joined(self.low, self.starts, self.ends, i, length)


def _joined(low, starts, ends, i: int, length: int) -> bytes:
    return b" ".join(low[s:e].tobytes() for s, e in zip(starts[i:i + length], ends[i:i + length], strict=True))


def window_set(items: Iterable[tuple[object, str | None]], size: int) -> WindowSet:
    """The windows of ``(id, text)`` rows, ``size`` words each, or all words of a shorter text."""
    ids, texts = [], []
    for item, text in items:
        ids.append(None if item is None else str(item))
        texts.append((text or "").encode())
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    low, starts, ends, hashes, first = Tokenizer().words(np.frombuffer(b"".join(texts), np.uint8), offsets)
    n_words = np.diff(first)
    piece = np.repeat(np.arange(len(ids)), n_words)
    by_length = {}
    for length in np.unique(np.minimum(n_words, size)).tolist():
        if not length:
            continue
        seen = windows(hashes, length)
        own = np.minimum(n_words, size)[piece[:len(seen)]] == length
        at = np.flatnonzero(own & starts_within(first, length, len(hashes)))
        at = at[np.argsort(seen[at], kind="stable")]
        by_length[length] = seen[at], at
    return WindowSet(low, starts, ends, piece, ids, by_length)


def hits(known: WindowSet, low, starts, ends, hashes, first) -> Iterator[tuple[int, int, set]]:
    """``(first word, number of words, items)`` of every verified occurrence of a window."""
    for length, (sorted_hashes, at) in known.by_length.items():
        seen = windows(hashes, length)
        if not len(seen):
            continue
        begin = np.searchsorted(sorted_hashes, seen)
        same = sorted_hashes[np.minimum(begin, len(sorted_hashes) - 1)] == seen
        for i in np.flatnonzero(same & starts_within(first, length, len(hashes))).tolist():
            words, end = _joined(low, starts, ends, i, length), int(np.searchsorted(sorted_hashes, seen[i], "right"))
            of = [at[k] for k in range(int(begin[i]), end) if known.words(int(at[k]), length) == words]
            if of:
                yield i, length, {known.ids[known.piece[k]] for k in of} - {None}


def _runs(mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _texts(batch: pa.RecordBatch, text: str, tokenizer: Tokenizer):
    """For each chunk of a batch: its first row and offsets, and its words."""
    data, offsets = utf8(batch.column(text))
    for a, b in chunks(offsets):
        own = offsets[a:b + 1] - offsets[a]
        yield a, own, tokenizer.words(data[offsets[a]:offsets[b]], own)


def _found(known: WindowSet, words) -> tuple[np.ndarray, dict[int, set]]:
    """Where runs of hit words begin and end (running sum above 0), and the items by text."""
    low, starts, ends, hashes, first = words
    change, of = np.zeros(len(starts) + 1, np.int64), {}
    for i, length, ids in hits(known, low, starts, ends, hashes, first):
        change[i] += 1
        change[i + length] -= 1
        of.setdefault(int(np.searchsorted(first, i, "right")) - 1, set()).update(ids)
    return np.cumsum(change[:-1]) > 0, of


def _described(batch: pa.RecordBatch, n_words, n_hit, items, spans) -> pa.RecordBatch:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
        names=[*batch.schema.names, *OUT.names])


def _scan(known, text: str):
    """A ``mapInArrow`` function that appends the columns of OUT; ``known`` is a broadcast window set, or None where
    the last two columns, ranges of hit words and item ids (null: no hit), say it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for batch in batches:
            rows = batch.num_rows
            if known is None:
                ranges, ids_of = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            n_words, n_hit = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            items: list[list[str]] = [[] for _ in range(rows)]
            spans: list[list[dict]] = [[] for _ in range(rows)]
            for a, own, words in _texts(batch, text, tokenizer):
                _, starts, ends, _, first = words
                n_words[a:a + len(own) - 1] = np.diff(first)
                if known is None:
                    hit, of = np.zeros(len(starts), bool), {}
                    for r in range(len(own) - 1):
                        if ranges[a + r].is_valid:
                            of[r] = set(ids_of[a + r].as_py())
                            for w in ranges[a + r].as_py():
                                hit[first[r] + w["start"]:first[r] + w["end"]] = True
                else:
                    hit, of = _found(known.value, words)
                for r, ids in of.items():
                    mine = hit[first[r]:first[r + 1]]
                    n_hit[a + r] = mine.sum()
                    items[a + r] = sorted(ids)
                    spans[a + r] = [{"start": int(starts[first[r] + s] - own[r]), "end": int(ends[first[r] + e - 1] - own[r])}
                                    for s, e in zip(*_runs(mine), strict=True)]
            if known is None:
                batch = batch.select(range(batch.num_columns - 2))
            yield _described(batch, n_words, n_hit, items, spans)

    return run


#: Hit words of a text in one round.
ROUND = T.StructType([
    T.StructField("_a", T.LongType()), T.StructField("_b", T.LongType()),
    T.StructField("_ranges", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("_items", T.ArrayType(T.StringType())),
])


def _round(known):
    """A ``mapInArrow`` function from ``_a, _b, _text`` to ROUND, for the texts that one round hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for batch in batches:
            at, ranges, items = [], [], []
            for a, _, words in _texts(batch, "_text", tokenizer):
                first = words[4]
                hit, of = _found(known.value, words)
                for r, ids in of.items():
                    at.append(a + r)
                    items.append(sorted(ids))
                    ranges.append([{"start": int(s), "end": int(e)} for s, e in zip(*_runs(hit[first[r]:first[r + 1]]), strict=True)])
            rows = pa.array(at, pa.int64())
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(ranges, pa.list_(span)), pa.array(items, pa.list_(pa.string()))],
                names=ROUND.names)

    return run


def pieces(items: DataFrame, size: int, piece_words: int = PIECE_WORDS) -> DataFrame:
    """``id``, ``t`` of items cut into pieces of at most ``piece_words`` windows; every window lies in one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for batch in batches:
            ids, texts = [], []
            given = batch.column(0).to_pylist()
            for a, own, (low, starts, ends, _, first) in _texts(batch, "t", tokenizer):
                low = np.where(low == 0, 0x20, low).astype(np.uint8)
                for r in range(len(own) - 1):
                    n, w = int(first[r + 1] - first[r]), int(first[r])
                    for k in range(0, max(1, n - size + 1) if n else 0, piece_words):
                        last = min(k + piece_words + size - 1, n) - 1
                        ids.append(given[a + r])
                        texts.append(low[starts[w + k]:ends[w + last]].tobytes().decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["id", "t"])

    return items.mapInArrow(run, "id string, t string").distinct()


def rounds_of(parts: DataFrame, max_bytes: int) -> tuple[DataFrame, int]:
    """``parts`` with their ``round``, and the number of rounds; none is larger than ``max_bytes``, unless one piece is."""
    size = F.octet_length("t") + F.coalesce(F.octet_length("id"), F.lit(0))
    total, count = parts.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    rounds = -(-total // max_bytes) or 1
    while True:
        dealt = parts.withColumn("round", F.pmod(F.xxhash64("t", "id"), F.lit(rounds)))
        largest = 0 if rounds == 1 else dealt.groupBy("round").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0]
        if largest <= max_bytes or rounds > 4 * count:
            return dealt, rounds
        rounds += -(-rounds // 2)


def scan_contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       max_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit`` (words inside any window's occurrence), ``item_ids``
    (sorted, of items with occurring windows) and ``hit_spans`` (byte ranges of maximal hit runs)."""
    spark = docs.sparkSession
    docs = free_names(docs, OUT.names)
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("t"))
    parts, rounds = rounds_of(written(pieces(items, size), "benchmark-pieces"), max_bytes)

    def known(k: int):
        return spark.sparkContext.broadcast(window_set(((r.id, r.t) for r in parts.where(F.col("round") == k).toLocalIterator()), size))

    if rounds == 1:
        return docs.mapInArrow(_scan(known(0), text), T.StructType([*docs.schema.fields, *OUT.fields]))
    keyed = free_names(docs, ROUND.names)
    text = keyed.columns[docs.columns.index(text)]
    keys = F.xxhash64(text).alias("_a"), F.xxhash64(F.lit("second"), text).alias("_b")
    found = None
    for k in range(rounds):
        one = known(k)
        hit = written(keyed.select(*keys, F.col(text).alias("_text")).mapInArrow(_round(one), ROUND).groupBy("_a", "_b").agg(
            F.any_value("_ranges").alias("_ranges"), F.any_value("_items").alias("_items")), "benchmark-round")
        one.destroy()
        found = hit if found is None else found.union(hit)
    merged = found.groupBy("_a", "_b").agg(F.flatten(F.collect_list("_ranges")).alias("_ranges"),
                                           F.array_distinct(F.flatten(F.collect_list("_items"))).alias("_items"))
    own = [F.col(c) for c in keyed.columns]
    joined = keyed.select(*own, *keys).join(written(merged, "benchmark-hits"), ["_a", "_b"], "left").select(*own, "_ranges", "_items")
    return joined.mapInArrow(_scan(None, text), T.StructType([*keyed.schema.fields, *OUT.fields])).toDF(*docs.columns, *OUT.names)


def remove_documents(scanned: DataFrame) -> DataFrame:
    """The documents without any hit, with their own columns only."""
    return scanned.where("n_hit = 0").drop(*OUT.names)


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """All documents, the hit byte ranges cut out of their text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(batch.column("hit_spans").to_pylist()):
                if spans:
                    raw, keep, last = texts[i].encode(), [], 0
                    for s in spans:
                        keep.append(raw[last:s["start"]])
                        last = s["end"]
                    texts[i] = b"".join([*keep, raw[last:]]).decode()
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return scanned.mapInArrow(cut, scanned.schema).drop(*OUT.names)


def items_digest(ids: str = "item_ids"):
    """SHA-256 (lower-case hex) of the comma-joined, string-sorted item ids."""
    return F.sha2(F.array_join(F.col(ids), ","), 256)


def brute_force(docs: list[tuple[object, str | None]], items: list[tuple[object, str | None]], size: int = SIZE) -> list[tuple]:
    """``(doc, n_words, n_hit, item ids, digest)`` by comparing word lists; for tests."""
    import re

    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, other in items:
            q = words(other)
            length = min(size, len(q))
            for j in range(len(q) - length + 1) if length else ():
                for i in range(len(w) - length + 1):
                    if w[i:i + length] == q[j:j + length]:
                        hit.update(range(i, i + length))
                        ids.add(str(item))
        ordered = sorted(ids)
        out.append((doc, len(w), len(hit), ordered, hashlib.sha256(",".join(ordered).encode()).hexdigest()))
    return out
