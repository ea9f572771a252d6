import random

import pytest
from conftest import prose

from metaweave.llm import decontaminate as D


def scanned(df, bench, **kw):
    return [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.digest) for r in D.scan_contamination(df, bench, **kw).withColumn("digest", D.items_digest()).collect()]


@pytest.fixture
def bench(spark):
    items = [(i, prose(12 + i, 500 + i)) for i in range(15)] + [(20, "just three words"), (21, "Mixed CASE, and-hyphen ünicode 42"), (22, None), (23, "..."), (9, prose(30, 900)), (None, prose(15, 901))]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("options", [{}, {"max_bytes": 300}])
def test_against_brute_force(docs, bench, options):
    rng, items = random.Random(3), [(r.item_id, r.text) for r in bench.collect()]
    texts = []
    for i in range(50):
        words = prose(rng.randrange(1, 60), i).split()
        if i % 2:
            own = (rng.choice(items)[1] or "x").split()
            words[rng.randrange(len(words)):0] = [w.upper() if i % 4 == 1 else w for w in own[rng.randrange(3):]]
        texts.append(("\n" if i % 5 else " ; ").join(words))
    texts += ["JUST three... words", "just three", "mixed case and hyphen Ünicode 42", "mixed case and hyphen ünicode 42!", items[0][1] + " " + items[0][1], "", None]
    df = docs(texts)
    named = [(i, t) for i, t in items if i is not None]
    want = {d: (n, h, ids, g) for d, n, h, ids, g in D.brute_force(list(enumerate(texts)), named)}
    whole = {d: h for d, _, h, _, _ in D.brute_force(list(enumerate(texts)), items)}  # an item without an id still marks words
    got = scanned(df, bench, **options)
    assert len(got) == len(texts)
    assert all((n, ids, g) == (want[d][0], want[d][2], want[d][3]) and h == whole[d] for d, n, h, ids, g in got)
    assert sum(r[2] > 0 for r in got) > 15


def test_rounds_hold_bounded_parts_of_the_benchmark(spark, docs):
    long = prose(100, 77)
    items = spark.createDataFrame([("a", long), ("b", prose(9, 78)), ("c", prose(40, 79)), ("d", None)], "id string, t string")
    parts = D.pieces(items, 10, piece_words=8)
    dealt, rounds = D.rounds_of(parts, 400)
    sizes = [sum(len(r.t) + len(r.id) for r in dealt.collect() if r["round"] == k) for k in range(rounds)]
    assert rounds >= 3 and max(sizes) <= 400
    words = [r.t.split() for r in dealt.where("id = 'a'").collect()]
    cut = {" ".join(w[i:i + 10]) for w in words for i in range(len(w) - 9)}
    plain = long.replace(".", "").replace(",", "").split()
    assert cut == {" ".join(plain[i:i + 10]) for i in range(91)} and max(map(len, words)) == 17
    assert [r.t.split() for r in dealt.where("id = 'b'").collect()] == [prose(9, 78).replace(".", "").replace(",", "").split()]
    # Hits of several rounds in one text are merged, copies of a text and a null text keep their rows.
    bench = items.toDF("item_id", "text")
    df = docs([long, long, None, prose(9, 78) + " " + prose(40, 79), "no hit at all"])
    one, many = ([(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.hit_spans) for r in sorted(D.scan_contamination(df, bench, max_bytes=m).collect(), key=lambda r: r.doc_id)]
                 for m in (1 << 20, 400))
    assert one == many and [r[2] for r in one] == [100, 100, 0, 49, 0] and one[3][3] == ["b", "c"]


def test_odd_rows_in_rounds(odd_docs, bench):
    got, want = ([tuple(r) for r in D.scan_contamination(odd_docs, bench, max_bytes=m).collect()] for m in (1000, 1 << 20))
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_spans_are_cut_and_documents_removed(docs, bench):
    item = bench.where("item_id = 3").first().text
    df = docs([f"Before it. {item} After it.", "clean text"])
    out = {r.doc_id: r.text for r in D.remove_spans(D.scan_contamination(df, bench)).collect()}
    assert out[1] == "clean text" and out[0].startswith("Before it. ") and out[0].endswith(" After it.") and item[:40] not in out[0]
    assert [r.doc_id for r in D.remove_documents(D.scan_contamination(df, bench)).collect()] == [1]


def test_odd_rows(spark, odd_docs, no_docs, bench):
    rows = D.scan_contamination(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count() and {"in_n_words", "in_n_hit", "in_item_ids", "in_hit_spans"} <= set(rows[0].asDict())
    by = {r.doc_id: r for r in rows}
    assert (by[3].n_words, by[4].n_words, by[5].n_words, by[6].n_words, by[7].n_words) == (0, 0, 0, 30_000, 2)
    assert D.scan_contamination(no_docs, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in D.scan_contamination(odd_docs, empty).collect())
    assert D.remove_documents(D.scan_contamination(odd_docs, bench)).columns == [c if c not in D.OUT.names else f"in_{c}" for c in odd_docs.columns]
