import random

import pytest

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ru") for b in ("ta", "ne", "so", "vi", "du") for c in ("m", "ra", "st", "x", "ly")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS))
        if i % 9 == 8:
            out[-1] += rng.choice([".", ".\n", ","])
    return " ".join(out)


def rows(texts, first=0):
    return [(first + i, t, ("aa", "bb")[i % 2], f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture
def docs(spark):
    """Makes a documents table of texts, numbered from ``first``."""
    def make(texts, first=0):
        return spark.createDataFrame(rows(texts, first), SCHEMA)
    return make


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal texts, and clashing extra columns."""
    long = prose(30_000, 1)
    table = [
        (1, prose(60, 2), "aa", "s0", 1), (1, prose(60, 2), "aa", "s0", 1), (2, prose(60, 2), "aa", "s0", 1), (None, prose(40, 3), None, None, None),
        (3, None, "aa", "s1", 0), (4, "", "bb", "s1", 0), (5, " \n\t ", "bb", None, 3), (6, long, "bb", "s2", len(long)), (7, "12 34 !!", "aa", "s2", 8),
        (None, None, None, None, None), (8, "é", "aa", "s2", 1), (9, "a" * 400, "bb", "s0", 400),
    ]
    clash = ("score", "lang_pred", "Shard", "slot", "copy_no", "rate", "n_words", "n_hit", "item_ids", "hit_spans", "kept", "removed_spans", "margin", "known_share")
    df = spark.createDataFrame(table, SCHEMA)
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in clash])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
