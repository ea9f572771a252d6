import random

import pytest
from conftest import prose

from metaweave.llm import language_id as L

SYLLABLES = {"aa": ("ka", "to", "mi"), "bb": ("sch", "ung", "ber"), "cc": ("eau", "oux", "é")}


def speech(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def filters(spark):
    rows = [(speech(lang, 40, f"{lang}{i}"), lang) for lang in SYLLABLES for i in range(60)] + [("x" * 50, None), (None, "aa")]
    return L.train(spark.createDataFrame(rows, "text string, lang string"))


def test_held_out_accuracy(spark, filters):
    rows = [(speech(lang, 1 + i % 20, f"new{lang}{i}").capitalize() + "!", lang) for lang in SYLLABLES for i in range(50)]
    got = L.identify(spark.createDataFrame(rows, "text string, lang string"), filters).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 < r.score <= 1 and 0 < r.known_share <= 1 for r in got)


def test_mixed_text_goes_to_the_larger_part(spark, filters):
    rows = [(speech("aa", 30, 1) + "\n" + speech("bb", 8, 2),), (speech("bb", 30, 3) + " " + speech("cc", 8, 4),)]
    assert [r.lang_pred for r in L.identify(spark.createDataFrame(rows, "text string"), filters).collect()] == ["aa", "bb"]


def test_a_lookup_returns_all_languages():
    import numpy as np
    grams = {f"l{i:02}": [7, 1000 + i] for i in range(20)}  # more languages than one mask holds
    own = L.Filters(grams, slots=1 << 12)
    def mask(gram):
        at = L._slots(np.array([gram], np.uint64), own.slots, own.hashes)
        out = [t[at[0]] & t[at[1]] & t[at[2]] for t in own.tables]
        return {own.languages[8 * t + b] for t, m in enumerate(out) for b in range(8) if m[0] >> b & 1 and 8 * t + b < 20}
    assert mask(7) == set(grams) and "l13" in mask(1013)


def test_false_positives_are_taken_out():
    import numpy as np
    rng = np.random.default_rng(0)
    full = L.Filters({"x": list(range(100)), "y": rng.integers(1 << 40, size=3000).tolist()}, slots=4096)
    assert full.rates[1] > 0.5 > full.rates[0]
    text = np.frombuffer(prose(300, 9).encode(), np.uint8)
    share = full.shares(text, np.array([0, len(text)]), L.letter_bytes())
    assert share[0, 1] < 0.15


def test_odd_rows(odd_docs, no_docs, filters):
    rows = L.identify(odd_docs, filters).collect()
    assert len(rows) == odd_docs.count() and {"in_score", "in_lang_pred", "in_known_share"} <= set(rows[0].asDict())
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (3, 4, 5, 7))
    assert by[1][0].lang_pred == by[1][1].lang_pred == by[2][0].lang_pred and by[6][0].lang_pred in SYLLABLES
    assert L.identify(no_docs, filters).count() == 0


def test_nothing_to_learn(no_docs, docs):
    got = L.identify(docs(["some text", None]), L.train(no_docs)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
