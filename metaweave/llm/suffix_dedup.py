"""Exact substring dedup with run-length indexes: every byte inside a 100-byte string that also starts earlier.

Texts are UTF-8 bytes; matches never cross documents, and strings are judged on the input.

* Routing.  Each ``LENGTH``-byte string elects the smallest hashed ``GRAM``-byte piece inside it, so equal strings
  elect equal pieces.  Consecutive strings of a text that elect the same piece are one *context*: the bytes they
  cover, at most ``2 * LENGTH``.  Only hashes of contexts move: one row each, routed by the elected piece.
  Contexts that repeat whole need no index: all but the first are marked, copies inside a task before the exchange.
  Pieces that one context elected are done.
* Index.  The first occurrences of different contexts with a common piece meet in one block, a
  collection of near repeats.  A block builds the Burrows-Wheeler transform of its contexts, run-compressed, and keeps
  of the suffix array only the samples at run ends: the text position of the run's first suffix and that of the suffix before it.
* Matching statistics.  Between samples the suffix before moves in step with the text and its match shrinks by one
  byte a position, so the lengths of all matches stream out of one comparison per run.  Positions whose match
  reaches ``LENGTH`` bytes are linked to the suffix before; of each chain all strings but the earliest are marked.
* Marked strings return to their documents as (start, number of strings), and their bytes are cut out.

A piece elected by more than ``MAX_CONTEXTS`` different contexts (a short line that a third of all documents carry) is split:
its strings are told apart by 128-bit hashes alone: the earliest place of each is a minimum with map-side combine, and all
other places, found by an anti join on the place, are marked.  None of their bytes move, and no task sees all places of a
string.  Other pieces' blocks end at the first piece beyond ``BLOCK_BYTES``.

Defined results: a null text is empty; a text shorter than ``LENGTH`` keeps all its bytes; a null id sorts before all
others; rows that repeat an id and text are one document and get the same result; rows with the same id and other texts
are documents ordered by a checksum of the text (of an id with two texts of one checksum, by a 64-bit hash; of those, an id that is
not null may have ``CHECKSUMS`` different texts, more end in an error).  Other columns pass through; input columns named like an output column are renamed ``in_<name>``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaweave.functions.ordered import range_ordinal
from metaweave.functions.sizing import broadcast_if_small
from metaweave.llm.common import free_names, sorted_groups, written
from metaweave.llm.tokens import chunks, mix, utf8

LENGTH = 100
GRAM = 24
MAX_CONTEXTS = 20_000
BLOCK_BYTES = 2 << 20
PIECE_BYTES = 2 << 20  # a longer text is routed in overlapping pieces
NO_ID = -(1 << 63)
CHECKSUMS = 1 << 23

_BASE = 0x9E3779B97F4A7C15
_OTHERS = np.int64(128)  # flag: a later copy in its task, marked wherever the first one is


class Router:
    """Contexts of a chunk of texts: hashes of the elected piece and of the whole context."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.power = length, gram, np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            def powers(base):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                return np.cumprod(steps)
            self.power, self.inverse = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))

    def contexts(self, data: np.ndarray, offsets: np.ndarray):
        """``(piece, whole, start, count)``: hashes, first string's start in ``data`` and number of strings."""
        n, none = len(data), np.zeros(0, np.int64)
        if n < self.length:
            return none.view(np.uint64), none.view(np.uint64), none, none
        self._powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=total[1:])
        gram = mix((total[self.gram:] - total[:-self.gram]) * self.inverse[:n - self.gram + 1])
        width = self.length - self.gram + 1
        bits = np.uint64((1 << max(1, n.bit_length())) - 1)
        low = (gram & ~bits) | np.arange(len(gram), dtype=np.uint64)  # ties go to the leftmost
        size = 1
        while 2 * size <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[:size - width], low[width - size:])
        at = (low & bits).astype(np.int64)
        # Strings begin at least LENGTH bytes before their text's end.
        change = np.zeros(n + 1, np.int32)
        ends = offsets[1:]
        np.add.at(change, offsets[:-1], 1)
        np.add.at(change, np.maximum(ends - self.length + 1, offsets[:-1]), -1)
        inside = (np.cumsum(change)[:len(at)] > 0)
        same = np.zeros(len(at), bool)
        same[1:] = inside[1:] & inside[:-1] & (at[1:] == at[:-1])
        start = np.flatnonzero(inside & ~same)
        last = inside.copy()
        last[:-1] &= ~same[1:]
        stop = np.flatnonzero(last)
        count = stop - start + 1
        end = stop + self.length
        whole = mix((total[end] - total[start]) * self.inverse[start] + count.astype(np.uint64))
        return gram[at[start]], whole, start, count


def _pieces(offsets: np.ndarray, a: int, b: int, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Byte range, row numbers and row starts of a chunk; a long text comes in pieces that share length - 1 bytes."""
    if b - a > 1 or offsets[b] - offsets[a] <= PIECE_BYTES:
        yield int(offsets[a]), int(offsets[b]), np.arange(a, b), np.zeros(b - a, np.int64)
        return
    first, end = int(offsets[a]), int(offsets[b])
    for at in range(first, max(first + 1, end - length + 1), PIECE_BYTES):
        yield at, min(end, at + PIECE_BYTES + length - 1), np.array([a]), np.array([at - first])


def _route(length: int, gram: int):
    """``mapInArrow``: id, checksum, text to one row a context; ``place`` packs checksum, start and count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router(length, gram)
        for batch in batches:
            ids, sums = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offsets = utf8(batch.column(2))
            for a, b in chunks(offsets):
                for first, end, rows, skipped in _pieces(offsets, a, b, length):
                    own = offsets[a:b + 1] - first if len(rows) > 1 or b - a == 1 and end - first == offsets[b] - offsets[a] else np.array([0, end - first])
                    piece, whole, start, count = router.contexts(data[first:end], own)
                    row = np.searchsorted(own, start, "right") - 1
                    doc = ids[rows[row]]
                    place = (sums[rows[row]] << 40) | ((start - own[row] + skipped[row]) << 8) | count
                    # Copies inside the chunk: the earliest is routed by its piece, the others are spread.
                    order = np.lexsort((place, doc, whole, piece))
                    piece, whole, doc, place = piece[order], whole[order], doc[order], place[order]
                    again = np.zeros(len(doc), bool)
                    again[1:] = (piece[1:] == piece[:-1]) & (whole[1:] == whole[:-1])
                    repeat = again.copy()
                    repeat[1:] &= (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
                    leader = np.maximum.accumulate(np.where(again, 0, np.arange(len(doc))))
                    repeat |= again & (doc == doc[leader]) & (place == place[leader])
                    route = np.where(again, mix(piece + whole + place.view(np.uint64) + doc.view(np.uint64)), piece).view(np.int64)
                    place = np.where(again, place | _OTHERS, place)
                    keep = ~repeat
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(route[keep]), pa.array(whole.view(np.int64)[keep]), pa.array(doc[keep]), pa.array(place[keep])],
                        names=["route", "whole", "doc", "place"])
    return run


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The suffix array of a collection by prefix doubling; ``left`` is each position's distance to its string's end.

    Suffixes end with their string; equal ones are ordered by position.
    """
    n = len(text)
    symbols = np.concatenate((text.astype(np.int64) + 1, np.zeros(8, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(7):  # seven symbols of nine bits
        key = (key << 9) | np.where(left > j, symbols[j:j + n], 0)
    reach, most = 7, int(left.max(initial=0))
    while True:
        order = np.argsort(key, kind="stable")
        if reach >= most:
            return order
        rank = np.empty(n, np.int64)
        ordered = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        ahead = np.zeros(n, np.int64)
        ahead[:n - reach] = rank[reach:] + 1
        key = rank * (n + 1) + np.where(left > reach, ahead, 0)
        reach *= 2


class RunIndex:
    """The run-compressed transform of a collection: run symbols, run lengths and samples at run ends."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, left: np.ndarray):
        order = suffix_order(text, left)
        before = text[order - 1].astype(np.int16)
        begins = np.zeros(len(text), bool)
        begins[starts] = True
        before[begins[order]] = -1  # a string's first suffix has nothing before it and is a run of its own
        head = np.ones(len(text), bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] < 0)
        at = np.flatnonzero(head)
        self.symbols, self.lengths = before[at], np.diff(np.append(at, len(text)))
        position = order[at]
        previous = np.where(at > 0, order[np.maximum(at - 1, 0)], -1)
        by = np.argsort(position)
        self.position, self.previous = position[by], previous[by]

    def statistics(self, text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every text position the length of its match with the suffix before it, and where that suffix starts."""
        padded = np.concatenate((text, np.zeros(8, np.uint8)))
        eight = np.lib.stride_tricks.as_strided(padded, (len(text) + 1, 8), (1, 1)).copy().view(np.uint64).ravel()
        a, b = self.position, self.previous
        length = np.zeros(len(a), np.int64)
        limit = np.where(b >= 0, np.minimum(left[a], left[np.maximum(b, 0)]), 0)
        active = np.flatnonzero(limit > 0)
        while len(active):
            differ = eight[a[active] + length[active]] ^ eight[b[active] + length[active]]
            equal = differ == 0
            bytes_equal = np.where(equal, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // 8)
            length[active] += bytes_equal
            active = active[equal]
            active = active[length[active] < limit[active]]
        length = np.minimum(length, limit)
        steps = np.diff(np.append(a, len(text)))
        moved = np.arange(len(text)) - np.repeat(a, steps)
        return np.repeat(length, steps) - moved, np.repeat(b, steps) + moved


def later_strings(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Flags the positions of a collection whose ``length``-byte string also starts at an earlier position."""
    ends = np.append(starts[1:], len(text))
    left = np.repeat(ends, ends - starts) - np.arange(len(text))
    match, other = RunIndex(text, starts, left).statistics(text, left)
    linked = np.flatnonzero((left >= length) & (match >= length))
    head = np.arange(len(text))
    head[linked] = other[linked]
    while True:
        further = head[head[linked]]
        if (further == head[linked]).all():
            break
        head[linked] = further
    members = np.union1d(linked, head[linked])
    first = np.full(len(text), -1)
    first[head[members[::-1]]] = members[::-1]  # the last write, of the smallest position, stays
    later = np.zeros(len(text), bool)
    later[members] = members != first[head[members]]
    return later


def _index(length: int, block_bytes: int):
    """``mapInArrow`` over contexts sorted by key: the marked strings of each block, as start and count."""
    def block(parts: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(parts).combine_chunks()
        doc, place = np.asarray(table.column("doc")), np.asarray(table.column("place"))
        order = np.lexsort((place, doc))
        table = table.take(pa.array(order))
        doc, start, crc = doc[order], (place[order] >> 8) & 0xFFFFFFFF, place[order] >> 40
        text, offsets = utf8(table.column("bytes"))
        marked = later_strings(text, offsets[:-1], length)
        of = np.repeat(np.arange(len(doc)), np.diff(offsets))
        at = np.flatnonzero(marked)
        begin = np.ones(len(at), bool)
        begin[1:] = (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])
        count = np.diff(np.append(np.flatnonzero(begin), len(at)))
        at = at[begin]
        row = of[at]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[row]), pa.array(crc[row]), pa.array(start[row] + at - offsets[row]), pa.array(count.astype(np.int64))],
            names=["doc", "crc", "start", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for group in sorted_groups(batches):
            parts.append(group)
            size += group.column("bytes").nbytes
            if size >= block_bytes:
                yield block(parts)
                parts, size = [], 0
        if parts:
            yield block(parts)
    return run


def _wanted(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Row, document, route, place, start and number of strings of every wanted context of a batch."""
    docs, wanted = np.asarray(batch.column("doc")), batch.column("wanted")
    bounds, flat = np.asarray(wanted.offsets), wanted.flatten()
    route, place = (np.asarray(flat.field(i)) for i in range(2))
    for r in range(batch.num_rows):
        for i in range(bounds[r] - bounds[0], bounds[r + 1] - bounds[0]):
            p = int(place[i])
            yield r, docs[r], route[i], p, (p >> 8) & 0xFFFFFFFF, p & 127


def _fetch(length: int):
    """``mapInArrow``: text and wanted contexts to context bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            keys, doc, places, own = [], [], [], []

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(doc, pa.int64()), pa.array(places, pa.int64()), pa.array(own, pa.binary())],
                    names=["key", "doc", "place", "bytes"])

            held = 0
            for r, d, route, p, start, count in _wanted(batch):
                at = int(offsets[r]) + start
                keys.append(route)
                doc.append(d)
                places.append(p)
                own.append(raw[at:at + count - 1 + length])
                held += count + length
                if held >= 8 << 20:
                    yield out()
                    keys, doc, places, own, held = [], [], [], [], 0
            if keys:
                yield out()
    return run


def _strings(length: int):
    """``mapInArrow``: text and wanted contexts to one row a string: its hash (two longs) and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            hashes, doc, places = [], [], []

            def out():
                h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                return pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(doc, pa.int64()), pa.array(places, pa.int64())],
                    names=["key", "check", "doc", "place"])

            for r, d, _, p, start, count in _wanted(batch):
                at = int(offsets[r]) + start
                for j in range(count):
                    hashes.append(hash_bytes(raw[at + j:at + j + length]))
                    doc.append(d)
                    places.append((p >> 40 << 40) | (start + j) << 8 | 1)
                if len(doc) >= 1 << 16:
                    yield out()
                    hashes, doc, places = [], [], []
            if doc:
                yield out()
    return run


def hash_bytes(string: bytes) -> bytes:
    """A 128-bit hash that is the same in every process."""
    import hashlib

    return hashlib.blake2b(string, digest_size=16).digest()


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``_doc`` and ``_crc``, which together name one text each and order documents.

    ``_crc`` is a checksum of the text.  Where two texts of an id have the same, all texts of that id are numbered by a hash
    instead; null ids, which may be any number of rows, then go on at the next smallest ids.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumn("_doc", F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)))
    keyed = keyed.withColumn("_crc", F.crc32(given).bitwiseAND(F.lit(CHECKSUMS - 1)))
    texts = keyed.select("_doc", "_crc", F.xxhash64(given).alias("_hash"))
    clash = texts.groupBy("_doc", "_crc").agg(F.min("_hash").alias("_low"), F.max("_hash").alias("_high")).where("_low <> _high")
    clash = written(clash.select("_doc").distinct(), "clashing-ids")
    if clash.isEmpty():
        return keyed
    several = texts.select("_doc", "_hash").join(broadcast_if_small(clash), "_doc", "left_semi").distinct()
    numbered = range_ordinal(written(several, "clashing-texts"), ["_doc"], ["_hash"], "_rank")
    beyond = F.floor(F.col("_rank") / F.lit(CHECKSUMS)).cast("long")
    numbered = numbered.select(
        F.col("_doc").alias("_d"), F.col("_hash").alias("_h"), F.pmod("_rank", F.lit(CHECKSUMS)).cast("long").alias("_c"),
        F.when((F.col("_doc") == NO_ID) | (beyond == 0), F.col("_doc") + beyond).otherwise(
            F.raise_error(F.concat(F.lit("too many different texts of the id "), "_doc")).cast("long")).alias("_own"))
    met = keyed.join(broadcast_if_small(numbered), (F.col("_doc") == F.col("_d")) & (F.xxhash64(given) == F.col("_h")), "left")
    return met.select(*docs.columns, F.coalesce("_own", "_doc").alias("_doc"), F.coalesce("_c", "_crc").alias("_crc"))


def repeated_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                     max_contexts: int = MAX_CONTEXTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc``, ``crc``, ``start``, ``count``: runs of strings that also start earlier, as first start and number of strings."""
    return _repeated(_documents(docs.select(doc_id, text), doc_id, text), text, length, gram, max_contexts, block_bytes)


def _repeated(keyed: DataFrame, text: str, length: int = LENGTH, gram: int = GRAM, max_contexts: int = MAX_CONTEXTS,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``repeated_strings`` of documents that are named by ``_doc`` and ``_crc``."""
    given = keyed.select(F.col("_doc").alias("doc"), F.col("_crc").alias("crc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = given.mapInArrow(_route(length, gram), "route long, whole long, doc long, place long")
    others = F.col("place").bitwiseAND(F.lit(128)) != 0
    piece = W.partitionBy("route")
    copies = W.partitionBy("route", "whole").orderBy("doc", "place")
    rows = rows.withColumn("contexts", F.when(F.min("whole").over(piece) == F.max("whole").over(piece), 1).otherwise(F.count(F.lit(1)).over(piece)))
    rows = rows.withColumn("first", F.first(F.struct("doc", "place")).over(copies))
    leads = F.struct("doc", "place") == F.col("first")
    rows = rows.withColumn("kind", F.when(others | ~leads, "copy").when(F.col("contexts") > 1, "index"))
    found = written(rows.where("kind IS NOT NULL").select("kind", "route", "doc", "place", (F.col("contexts") > max_contexts).alias("split")), "contexts")

    start = F.shiftrightunsigned("place", 8).bitwiseAND(F.lit(0xFFFFFFFF))
    copied = found.where("kind = 'copy'").select("doc", F.shiftrightunsigned("place", 40).alias("crc"), start.alias("start"),
                                                 F.col("place").bitwiseAND(F.lit(127)).alias("count"))
    wanted = found.where("kind = 'index'").select("doc", F.shiftrightunsigned("place", 40).alias("crc"), "route", "place", "split").distinct()
    whole = wanted.where(~F.col("split"))
    blocks = max(1, -(-whole.count() * 2 * length // block_bytes))

    def texts(contexts: DataFrame) -> DataFrame:
        own = contexts.groupBy("doc", "crc").agg(F.collect_list(F.struct("route", "place")).alias("wanted"))
        return given.join(own, ["doc", "crc"]).dropDuplicates(["doc", "crc"]).select("doc", "text", "wanted")

    parts = texts(whole).mapInArrow(_fetch(length), "key long, doc long, place long, bytes binary")
    parts = parts.repartition(blocks, "key").sortWithinPartitions("key")
    marked = copied.unionByName(parts.mapInArrow(_index(length, block_bytes), "doc long, crc long, start long, count long"))
    hot = wanted.where("split")
    if hot.isEmpty():
        return marked
    strings = texts(hot).mapInArrow(_strings(length), "key long, check long, doc long, place long")
    strings = written(strings, "strings")
    first = strings.groupBy("key", "check").agg(F.min(F.struct("doc", "place")).alias("first")).select("first.*")
    later = strings.select("doc", "place").join(first, ["doc", "place"], "left_anti")
    return marked.unionByName(later.select("doc", F.shiftrightunsigned("place", 40).alias("crc"), start.alias("start"), F.lit(1).cast("long").alias("count")))


OUT = T.StructType([
    T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
])


def _cut(text: str, length: int, columns: list[str]):
    """``mapInArrow``: text and marked strings to maximal removed byte ranges and the bytes that stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            marks = batch.column(batch.schema.get_field_index("_marks"))
            spans, kept = [], []
            for r, own in enumerate(marks):
                raw = data[offsets[r]:offsets[r + 1]]
                if not own.is_valid or not len(own.values):
                    spans.append([])
                    kept.append(raw.tobytes())
                    continue
                start, count = np.asarray(own.values.field(0)), np.asarray(own.values.field(1))
                change = np.zeros(len(raw) + 1, np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, start + count - 1 + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                spans.append([{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(columns))],
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[*columns, *OUT.names])
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """Every row of ``docs`` with ``removed_spans`` (maximal byte ranges) and ``kept`` (the other bytes, in order)."""
    docs = free_names(docs, [*OUT.names, "_doc", "_crc", "_hash", "_marks", "_d", "_c", "_h", "_own"])
    keyed = _documents(docs, doc_id, text)
    marks = _repeated(keyed, text, length, **options)
    marks = marks.groupBy(F.col("doc").alias("_d"), F.col("crc").alias("_c")).agg(F.collect_list(F.struct("start", "count")).alias("_marks"))
    met = keyed.join(marks, (F.col("_doc") == F.col("_d")) & (F.col("_crc") == F.col("_c")), "left").select(*docs.columns, "_marks")
    return met.mapInArrow(_cut(text, length, docs.columns), T.StructType([*docs.schema.fields, *OUT.fields]))


def brute_force(docs: list[tuple[int, str | None]], length: int = LENGTH) -> dict[int, list[tuple[int, int]]]:
    """Maximal removed byte ranges of each document, by a dictionary of all strings; for tests with unique ids."""
    seen: set[bytes] = set()
    out = {}
    for doc, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            string = raw[i:i + length]
            if string in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(string)
        edge = [i for i in range(len(raw) + 1) if (gone[i] if i < len(raw) else 0) != (gone[i - 1] if i else 0)]
        out[doc] = list(zip(edge[::2], edge[1::2], strict=True))
    return out
