"""Mixing sources to target weights by Poisson replication, with Spark expressions only.

Every source has a target share of the mixture.  Its repetition rate is the mean number of
copies of each of its documents that gives it that share of ``total`` bytes.  A document's
number of copies is drawn from the Poisson distribution with that mean by inverting its
distribution function at a uniform number hashed from the seed and the document's id, so the
draw is the same on every run and every machine, and no counter is shared between tasks.
Documents are exploded by their counts, and a hash of id, copy and seed deals the copies to
partitions and orders them there: a global shuffle in one exchange that no source can skew.

A rate above ``STEP`` is drawn as a sum of equal smaller ones, so that large rates do not underflow.

Defined results: a null source is a source of its own; a null text has no bytes; a source
without any byte or with no target weight has rate 0 and gives no copies (weights name the
mixture's sources); an id that is null is replaced by a hash of the text; repeated rows are
drawn alike, each on its own; an empty table gives an empty mixture.  Input columns named like
an output column are renamed ``in_<name>``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaweave.functions.sizing import at_most
from metaweave.llm.common import free_names, written

SEED = 20240501
TEMPERATURE = 2.0
STEP = 32.0
#: Rates are broadcast up to so many sources; beyond, the join is left to the planner, which splits hot sources.
MAX_BROADCAST_SOURCES = 50_000


def uniform(*parts: Column) -> Column:
    """A uniform number in [0, 1) with 52 bits, hashed from the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None,
                 source: str = "source", text: str = "text", temperature: float = TEMPERATURE) -> DataFrame:
    """``src``, ``bytes``, ``target`` (share of the mixture), ``rate`` (mean copies of a document), ``parts`` and
    ``cdf`` (of the Poisson distribution with mean ``rate / parts``) for every source.

    Without ``weights`` a source's target is its size to the power ``1 / temperature``, normalised;
    ``total`` defaults to the corpus' bytes.
    """
    sizes = docs.groupBy(F.col(source).cast("string").alias("src")).agg(
        F.sum(F.coalesce(F.octet_length(text), F.lit(0))).cast("long").alias("bytes"))
    sizes = written(sizes, "source-sizes")
    if weights is None:
        raw = sizes.withColumn("raw", F.pow(F.col("bytes").cast("double"), F.lit(1.0 / temperature)))
    else:
        raw = sizes.withColumn("raw", F.lit(0.0))
        for name, w in weights.items():
            raw = raw.withColumn("raw", F.when(F.col("src").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(F.col("raw")))
    all_raw, all_bytes = raw.agg(F.sum("raw"), F.sum("bytes")).first()
    wanted = float(total if total is not None else all_bytes or 0)
    rates = raw.withColumn("target", F.col("raw") / F.lit(all_raw) if all_raw else F.lit(0.0)).withColumn(
        # Rounded, so that the order in which sums were added up cannot change a draw.
        "rate", F.when(F.col("bytes") > 0, F.round(F.col("target") * F.lit(wanted) / F.col("bytes"), 6)).otherwise(0.0))
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int"))
    mean = F.col("rate") / F.col("parts")
    most = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.exp(-mean)
    grown = F.aggregate(
        F.sequence(F.lit(1), most), F.struct(start.alias("p"), F.array(start).alias("cdf")),
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf")))
    return rates.select("src", "bytes", "target", "rate", "parts", grown["cdf"].alias("cdf"))


def poisson_mixture(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None,
                    doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED,
                    temperature: float = TEMPERATURE) -> DataFrame:
    """The mixture: every copy of every document, with ``copy_no`` (from 1), ``rate`` and ``shuffle_key``, in global random order."""
    docs = free_names(docs, ["copy_no", "rate", "shuffle_key", "src", "parts", "cdf"])
    rates = written(source_rates(docs, weights, total, source, text, temperature), "source-rates").select("src", "rate", "parts", "cdf")
    if at_most(rates, MAX_BROADCAST_SOURCES):
        rates = F.broadcast(rates)
    own = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    drawn = docs.join(rates, F.col(source).cast("string").eqNullSafe(F.col("src")), "inner")
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")), F.lit(0),
        lambda n, part: n + F.size(F.filter(F.col("cdf"), lambda c: c <= uniform(F.lit(seed), own, part))))
    drawn = drawn.withColumn("_copies", copies).where("_copies > 0")
    drawn = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    drawn = drawn.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), own, F.col("copy_no"), F.lit("order"))))
    return drawn.select(*docs.columns, "copy_no", "rate", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def inverse_poisson(mean: float, u: float) -> int:
    """The smallest count whose distribution function exceeds ``u``; the scalar model of the draw, for tests."""
    p, c, k = math.exp(-mean), math.exp(-mean), 0
    while c <= u and k < mean + 12 * math.sqrt(mean) + 20:
        k += 1
        p *= mean / k
        c += p
    return k
