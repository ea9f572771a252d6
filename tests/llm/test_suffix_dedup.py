import random
import zlib

import numpy as np
import pytest
from conftest import prose
from pyspark.sql import functions as F

from metaweave.llm import suffix_dedup as S


def spans(df, **options):
    return {r.doc_id: [(s.start, s.end) for s in r.removed_spans] for r in S.remove_repeats(df, **options).collect()}


def test_suffix_order_and_runs():
    rng = np.random.default_rng(3)
    for _ in range(100):
        strings = [bytes(rng.integers(97, 100, rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 9))]
        text = np.frombuffer(b"".join(strings), np.uint8)
        starts = np.cumsum([0] + [len(s) for s in strings])[:-1]
        left = np.concatenate([np.arange(len(s), 0, -1) for s in strings])
        suffixes = [(text[i:i + left[i]].tobytes(), i) for i in range(len(text))]
        order = S.suffix_order(text, left)
        assert order.tolist() == [i for _, i in sorted(suffixes)]
        index = S.RunIndex(text, starts, left)
        assert index.lengths.sum() == len(text) and len(index.position) == len(index.symbols) <= len(text)
        match, other = index.statistics(text, left)
        for i in range(len(text)):
            if match[i] > 0:
                assert text[i:i + match[i]].tobytes() == text[other[i]:other[i] + match[i]].tobytes() and other[i] != i


def test_later_strings_against_a_set():
    rng = np.random.default_rng(1)
    for _ in range(200):
        strings = [bytes(rng.integers(97, 99, rng.integers(1, 30)).astype(np.uint8)) for _ in range(rng.integers(1, 8))]
        length, seen, want = int(rng.integers(2, 9)), set(), []
        for s in strings:
            for i in range(len(s)):
                want.append(len(s[i:i + length]) == length and s[i:i + length] in seen)
                if len(s[i:i + length]) == length:
                    seen.add(s[i:i + length])
        text = np.frombuffer(b"".join(strings), np.uint8)
        assert S.later_strings(text, np.cumsum([0] + [len(s) for s in strings])[:-1], length).tolist() == want


@pytest.mark.parametrize("options", [{}, {"max_contexts": 2, "block_bytes": 3000}])
def test_against_brute_force(docs, options):
    rng = random.Random(4)
    passage, texts = prose(60, 10), []
    for i in range(60):
        own = prose(rng.randrange(5, 80), 20 + i)
        at = rng.randrange(len(own))
        texts.append(own[:at] + passage[rng.randrange(20):rng.randrange(200, len(passage))] + own[at:] if i % 3 else own)
    texts += [texts[1], texts[4], "ab" * 150, "ab" * 130, "ü" * 120, None, ""]
    df = docs(texts)
    want = S.brute_force(list(enumerate(texts)))
    assert spans(df, **options) == want and sum(map(bool, want.values())) > 30


def test_repeats_inside_a_document_and_across_pieces(docs, monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 700)
    base = prose(200, 30)
    texts = [base + " x " + base, "y" * 99, "y" * 99, base[100:900]]
    assert spans(docs(texts)) == S.brute_force(list(enumerate(texts)))


def test_odd_rows(odd_docs, no_docs):
    rows = S.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {"in_kept", "in_removed_spans", "Shard"} <= set(rows[0].asDict())
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [len(r.removed_spans) for r in by[1]] == [0, 0]  # a repeated row is the same document
    assert bytes(by[2][0].kept) == b"" and bytes(by[3][0].kept) == b"" and bytes(by[9][0].kept) == b"a"  # every later run of 100 starts after the first byte
    assert S.remove_repeats(no_docs).count() == 0


def test_a_string_with_many_contexts_meets_in_no_task(docs, monkeypatch):
    """A footer with other text around it everywhere: the frame that goes into the blocks holds none of its copies."""
    rng = random.Random(8)
    footer = prose(40, 70)[:150]
    texts = [f"{rng.getrandbits(400):x}{footer}{rng.getrandbits(400):x}" for _ in range(120)]
    df, sent = docs(texts), []
    frame, plain = type(df), type(df).mapInArrow

    def spied(self, func, *args, **options):
        if func.__qualname__.startswith("_index."):
            sent.append(self.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return plain(self, func, *args, **options)

    monkeypatch.setattr(frame, "mapInArrow", spied)
    assert spans(df, max_contexts=10) == S.brute_force(list(enumerate(texts)))
    assert sent and max(sent) <= 10


def by_text(spark, rows):
    """Removed spans by text, and what brute force removes where documents of an id stand in the order of their texts' hashes."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = {order[i]: found for i, found in S.brute_force([(i, t) for i, (_, t) in enumerate(order)]).items()}
    got = {(r.doc_id, r.text): [(s.start, s.end) for s in r.removed_spans] for r in S.remove_repeats(df).collect()}
    return got, want


def test_texts_of_one_checksum(spark):
    """Two texts without an id, and two with the same, whose checksums agree; lengths differ, so that a mix-up would be out of bounds."""
    passage, seen, pair = prose(60, 1), {}, None
    while pair is None:
        text = f"{passage} {len(seen)} {'long tail ' * (len(seen) % 50)}"
        crc = zlib.crc32(text.encode()) & (S.CHECKSUMS - 1)
        if crc in seen and len(seen[crc]) != len(text):
            pair = seen[crc], text
        seen[crc] = text
    for doc in (None, 7):
        got, want = by_text(spark, [(doc, pair[0]), (doc, pair[1]), (9, passage), (9, passage)])
        assert got == want and sum(map(bool, got.values())) >= 2  # a tail may repeat itself


def test_more_texts_without_an_id_than_checksums(spark, monkeypatch):
    monkeypatch.setattr(S, "CHECKSUMS", 4)
    passage = prose(60, 1)
    rows = [(None, f"{prose(i + 5, i)} {passage} {i}") for i in range(11)] + [(3, f"{passage} a"), (3, f"b {passage}"), (4, passage)]
    got, want = by_text(spark, rows)
    assert got == want and sum(map(bool, got.values())) == len(rows) - 1
    with pytest.raises(Exception, match="too many different texts"):
        S.remove_repeats(spark.createDataFrame([(3, f"{i} {passage}") for i in range(9)], "doc_id long, text string")).collect()
