"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: slot ``i`` of the table holds a mask with
bit ``l`` set if language ``l``'s filter has that bit, so looking an n-gram up once (the AND of
its ``HASHES`` slots) returns all languages that contain it.  A text's n-grams are looked up at
once; per language the set bits are counted, corrected for that filter's rate of false
positives, and the language with the largest corrected share decides.

N-grams are runs of 3, 4 and 5 bytes of the lower-cased text in which every run of non-letters is one
space, with a space before and after.  A language's filter holds its most frequent n-grams,
counted (once a document) over a sample of the labelled rows bounded by ``SAMPLE_ROWS`` a
language; an n-gram counts for a language only if it is at least ``RATIO`` as common there as
in the language where it is most common, so that n-grams that stray in (quotations, noise) do
not blur the filters.

Defined results: a null text or one without letters is ``und`` with score 0; rows whose label
is null teach nothing; if nothing can be learned, every text is ``und``; ties go to the
language that sorts first; a text of letters none of whose n-grams is known gets the first
language with score 0.  Rows, repeated ids and extra columns pass through; input columns named
like an output column are renamed ``in_<name>``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaweave.llm.common import free_names
from metaweave.llm.tokens import chunks, mix, utf8, word_bytes

ORDERS = (3, 4, 5)
#: Expected number of sampled training rows a language, n-grams kept a language, slots and hashes of the filters.
SAMPLE_ROWS = 2000
GRAMS = 30_000
SLOTS = 1 << 20
HASHES = 3
RATIO = 0.2
UND = "und"


def _grams(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray):
    """Yields for each order the n-grams of a chunk as integers and the index of each one's text."""
    # A space between texts: every text begins and ends with a space, runs of spaces collapse.
    rows = len(offsets) - 1
    b = letters[data]
    b = np.insert(b, offsets[:-1], 32)
    of = np.repeat(np.arange(rows), np.diff(offsets) + 1)
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (of[1:] != of[:-1])
    b, of = b[keep], of[keep]
    b, of = np.append(b, 32), np.append(of, rows)
    wide = b.astype(np.uint64)
    gram = wide[:-1] | (wide[1:] << np.uint64(8))
    for order in range(3, max(ORDERS) + 1):
        n = len(b) - order + 1
        if n <= 0:
            return
        gram = gram[:n] | (wide[order - 1:] << np.uint64(8 * (order - 1)))
        # The last byte may be the space that begins the next text, no byte beyond it.
        inside = of[:n] == of[order - 2:order - 2 + n]
        yield order, gram[inside], of[:n][inside]


def letter_bytes() -> np.ndarray:
    """Letters and non-ASCII bytes as they are (lower case), everything else a space."""
    table = word_bytes()
    table[0x30:0x3A] = 0
    table[table == 0] = 32
    return table


def _slots(gram: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    h = mix(gram)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) % np.uint64(slots)).astype(np.int64) for k in range(hashes)]


class Filters:
    """The bit-sliced filters: tables of masks (eight languages each) and false-positive rates."""

    def __init__(self, grams: dict[str, list[int]], slots: int = SLOTS, hashes: int = HASHES):
        self.languages, self.slots, self.hashes = sorted(grams), slots, hashes
        self.tables = [np.zeros(slots, np.uint8) for _ in range(-(-len(grams) // 8))]
        rates = []
        for i, language in enumerate(self.languages):
            table = self.tables[i // 8]
            for at in _slots(np.array(grams[language], np.uint64), slots, hashes):
                table[at] |= np.uint8(1 << i % 8)
            rates.append(float((table >> np.uint8(i % 8) & np.uint8(1)).mean()) ** hashes)
        self.rates = np.array(rates)

    @classmethod
    def of(cls, state: dict) -> "Filters":
        """The filters whose ``__dict__`` was broadcast."""
        own = cls.__new__(cls)
        own.__dict__.update(state)
        return own

    def shares(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """For each text and language the share of n-grams in the language's filter, false positives taken out."""
        rows, n = len(offsets) - 1, len(self.languages)
        hits, total = np.zeros((rows, 8 * len(self.tables))), np.zeros(rows)
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        for order, gram, of in _grams(data, offsets, letters):
            if order not in ORDERS:
                continue
            total += np.bincount(of, minlength=rows)
            slots = _slots(gram, self.slots, self.hashes)
            for t, table in enumerate(self.tables):
                mask = table[slots[0]]
                for at in slots[1:]:
                    mask &= table[at]
                hits[:, 8 * t:8 * t + 8] += np.bincount(of * 256 + mask, minlength=rows * 256).reshape(rows, 256) @ bits
        share = hits[:, :n] / np.maximum(total, 1)[:, None]
        return np.clip((share - self.rates) / (1 - self.rates), 0, 1)


def _count(language: str, text: str):
    """A ``mapInArrow`` function: number of texts of each language that hold each n-gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_bytes()
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            names, codes = np.unique(np.array(batch.column(language).to_pylist(), object).astype(str), return_inverse=True)
            for a, b in chunks(offsets):
                own = offsets[a:b + 1] - offsets[a]
                for order, gram, of in _grams(data[offsets[a]:offsets[b]], own, letters):
                    if order not in ORDERS:
                        continue
                    # An n-gram takes 40 bits; the text's index, then its language's, take the rest.
                    once = np.unique((of.astype(np.uint64) << np.uint64(40)) | gram)
                    code = codes[a:b][(once >> np.uint64(40)).astype(np.int64)].astype(np.uint64)
                    gram = once & np.uint64((1 << 40) - 1)
                    pairs, n = np.unique((code << np.uint64(40)) | gram, return_counts=True)
                    code, gram = (pairs >> np.uint64(40)).astype(np.int64), pairs & np.uint64((1 << 40) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[code], pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)],
                        names=["lang", "gram", "n"])
    return run


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS,
          grams: int = GRAMS, slots: int = SLOTS, ratio: float = RATIO) -> Filters:
    """Filters learned from rows with a text and a label.  Collects at most ``grams`` n-grams a language."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.lower(text).alias("text"))
    # A hash of the text alone decides, so the sample is the same on every run and for every order of rows.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Filters({})
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, sample_rows / n)).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30))
    counts = sample.mapInArrow(_count("lang", "text"), "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    texts = sample.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    rate = counts.join(texts, "lang").withColumn("rate", F.col("n") / F.col("texts"))
    most = rate.groupBy("gram").agg(F.max("rate").alias("most"))
    kept = rate.where("n > 1 OR texts < 100").join(most, "gram").where(F.col("rate") >= ratio * F.col("most"))
    top = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("rate"), "gram")))
    found: dict[str, list[int]] = {name: [] for name in sizes}
    for r in top.where(F.col("rank") <= grams).select("lang", "gram").collect():
        found[r["lang"]].append(r["gram"])
    return Filters(found, slots)


OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                    T.StructField("known_share", T.DoubleType())])


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred``, ``score`` (the winner's part of all languages' shares, 0 to 1)
    and ``known_share`` (the winner's corrected share of the text's n-grams)."""
    docs = free_names(docs, [*OUT.names, "_low", "_letters"])
    model = docs.sparkSession.sparkContext.broadcast(dict(filters.__dict__))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, own = letter_bytes(), Filters.of(model.value)
        names = np.array([*own.languages, UND], object)
        for batch in batches:
            data, offsets = utf8(batch.column("_low"))
            rows, n = batch.num_rows, len(own.languages)
            pred, score, known = np.full(rows, n), np.zeros(rows), np.zeros(rows)
            if n:
                for a, b in chunks(offsets):
                    share = own.shares(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], letters)
                    pred[a:b] = share.argmax(axis=1)
                    known[a:b] = share.max(axis=1)
                    score[a:b] = known[a:b] / np.maximum(share.sum(axis=1), 1e-12)
            none = ~np.asarray(batch.column("_letters").fill_null(False))
            pred[none], score[none], known[none] = n, 0, 0
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(columns))], pa.array(names[pred], pa.string()), pa.array(score), pa.array(known)],
                names=[*columns, *OUT.names])

    given = docs.select("*", F.lower(text).alias("_low"), F.col(text).rlike(r"\p{L}").alias("_letters"))
    return given.mapInArrow(run, T.StructType([*docs.schema.fields, *OUT.fields]))
