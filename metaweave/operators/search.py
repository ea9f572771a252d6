"""Items 22, 26, 27: search documents read from the graph, an inverted index, BM25 ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metaweave.functions.exprs import node_key, tokens
from metaweave.functions.sizing import planned_bytes, tasks_for
from metaweave.model import S, TB
from metaweave.operators.graph import assembled_tables, graph_tasks
from metaweave.session import shuffles_removed

# BM25 parameters (Robertson & Zaragoza, 2009).
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 6


def search_documents(
    nodes: DataFrame,
    edges: DataFrame,
    last_updated: DataFrame | None = None,
    entity_type: str = "table",
) -> DataFrame:
    """Item 22: one document per table node, read from the graph:
    key, database, cluster, schema_name, name, description, column_names[],
    column_descriptions[] (nulls skipped), last_updated_epoch."""
    if entity_type != "table":
        raise ValueError(f"unsupported entity_type {entity_type!r}; only 'table' documents exist")
    none = F.array().cast("array<string>")
    docs = assembled_tables(nodes, edges).select(
        "key", "database", "cluster", S, "name", "description",
        F.coalesce(F.transform("columns", lambda c: c["name"]), none).alias("column_names"),
        F.coalesce(F.array_compact(F.transform("columns", lambda c: c["description"])), none).alias("column_descriptions"),
    )
    if last_updated is None:
        return docs.withColumn("last_updated_epoch", F.lit(None).cast("long"))
    lu = last_updated.select(node_key("db", "cluster", S, TB).alias("key"),
                             F.col("last_updated_time_epoch").alias("last_updated_epoch"))
    return docs.join(lu.repartition(graph_tasks(nodes, edges), "key"), "key", "left")


#: Fields of a document, in the order in which its terms are counted.
FIELDS = ("name", "description", "column_names", "column_descriptions")
#: Folders that postings are dealt into by term; a query reads the folders of its terms.
TERM_BUCKETS = 256
#: Bytes of documents whose postings one task sorts and writes; postings are several times larger.
POSTING_TASK_BYTES = 1 << 20
#: Ranks for which the dictionary bounds from below what a term's best documents score.
FLOORS = (1, 10, 100)
#: Estimated size of a query table whose terms are sent to all tasks; beyond it the joins are left to the planner.
MAX_QUERY_BYTES = 4 << 20
#: Hash values of candidates of a ranking that are sent to all tasks.
CANDIDATE_PLACES = 1 << 18
#: Documents of a query's other terms up to which its weak terms' postings are reduced to them.
MAX_CANDIDATES = CANDIDATE_PLACES // 8


def term_bucket(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class SearchIndex:
    """An inverted index.

    * ``postings(term, key, tf, doc_len, fields, bucket)``: how often a term stands in a document, the document's length in
      terms, and the term's 0-based positions in each field (``array<struct<field, positions>>``);
    * ``terms(term, df, max_tf, min_len, floors, bucket)``: in how many documents; its largest frequency and the shortest
      document, which bound what the term can add to any score; and for each ``rank`` of :data:`FLOORS` that it has as many
      documents for, the smallest frequency and the longest document of its ``rank`` best ones, which bound from below what
      that many documents score;
    * ``stats(n_docs, total_len)``: one row.
    """

    postings: DataFrame
    terms: DataFrame
    stats: DataFrame

    def write(self, path: str) -> SearchIndex:
        """Postings by ranges of (term, document), sorted: a term's postings lie together, a very common term's in many files."""
        spark = self.postings.sparkSession
        with shuffles_removed(spark):
            self.postings.repartitionByRange(tasks_for(self.postings, task_bytes=POSTING_TASK_BYTES), "bucket", "term", "key").sortWithinPartitions("bucket", "term", "key").write.partitionBy("bucket").parquet(f"{path}/postings")
            stored = spark.read.parquet(f"{path}/postings").select(*self.postings.columns)
            _terms(stored, self.stats).write.parquet(f"{path}/terms")
            self.stats.write.parquet(f"{path}/stats")
        return SearchIndex.read(spark, path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> SearchIndex:
        return SearchIndex(*[spark.read.parquet(f"{path}/{name}") for name in ("postings", "terms", "stats")])


def _terms(postings: DataFrame, stats: DataFrame) -> DataFrame:
    mean = stats.select(F.col("total_len") / F.greatest("n_docs", F.lit(1))).scalar()
    impact = F.col("tf") / (F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("doc_len") / F.greatest(F.coalesce(mean, F.lit(1.0)), F.lit(1.0))))
    # Planned as a limit per task before the shuffle: a common term ships a bounded number of rows per task.
    best = Window.partitionBy("term", "bucket").orderBy(impact.desc())
    top = postings.select("term", "bucket", "tf", "doc_len", F.row_number().over(best).alias("rn")).where(F.col("rn") <= FLOORS[-1])
    within = {r: F.col("rn") <= r for r in FLOORS}
    floors = top.groupBy("term", "bucket").agg(F.max("rn").alias("held"), F.array(*[
        F.struct(F.lit(r).alias("rank"), F.min(F.when(within[r], F.col("tf"))).alias("tf"), F.max(F.when(within[r], F.col("doc_len"))).alias("len"))
        for r in FLOORS]).alias("floors"))
    counts = postings.groupBy("term", "bucket").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("max_tf"), F.min("doc_len").alias("min_len"))
    return counts.join(floors, ["term", "bucket"]).select(
        "term", "df", "max_tf", "min_len", F.filter("floors", lambda f: f["rank"] <= F.col("held")).alias("floors"), "bucket")


def search_index(docs: DataFrame, buckets: int = TERM_BUCKETS) -> SearchIndex:
    """Item 26: the inverted index of search documents (see :class:`SearchIndex`), lazily.

    A document's terms are numbered, and counted, in its own row, so documents are scanned once and lengths need no join;
    elements of a list field follow one another.  One shuffle on (term, document) with partial counts: neither a common
    term nor a long document lands whole in one task.
    """
    kinds = dict(docs.dtypes)

    def of_field(no: int, name: str) -> Column:
        text = F.array_join(name, " ") if kinds[name].startswith("array") else F.col(name)
        terms = F.coalesce(tokens(text), F.array().cast("array<string>"))
        return F.transform(terms, lambda t, i: F.struct(t.alias("term"), F.lit(no).alias("f"), i.alias("p")))

    hits = F.flatten(F.array(*[of_field(no, name) for no, name in enumerate(FIELDS)]))
    counted = docs.select("key", hits.alias("hits")).select("key", F.size("hits").cast("long").alias("doc_len"), "hits")
    found = counted.select("key", "doc_len", F.inline("hits")).groupBy("term", "key").agg(
        F.count(F.lit(1)).alias("tf"), F.max("doc_len").alias("doc_len"), F.array_sort(F.collect_list(F.struct("f", "p"))).alias("hits"))

    def places(no: int, name: str) -> Column:
        own = F.filter("hits", lambda h: h["f"] == no)
        return F.struct(F.lit(name).alias("field"), F.transform(own, lambda h: h["p"]).alias("positions"))

    fields = F.array(*[places(no, name) for no, name in enumerate(FIELDS)])
    postings = found.select("term", "key", "tf", "doc_len", F.filter(fields, lambda f: F.size(f["positions"]) > 0).alias("fields"),
                            term_bucket("term", buckets).alias("bucket"))
    stats = counted.where("doc_len > 0").agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("total_len"))
    return SearchIndex(postings, _terms(postings, stats), stats)


def search_rank(queries: DataFrame, index: SearchIndex, k: int = 10, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Item 27: top-``k`` documents per query by BM25, ties broken by key.

    ``queries(query_id, text)``; output (query_id, rank, key, score) with the score rounded to 6 places before ranking.

    * The query's terms meet the term dictionary; each gets its weight, the most it can add to a score, and what its ``k``
      best documents score at least.  The largest of the latter is a bar: no document below it can be in the result.
    * The query's weakest terms that together cannot reach the bar need no candidates of their own: only documents with one
      of the other, rarer terms are scored, and the postings of weak, that is common, terms are reduced to those documents
      before they are exchanged.

    Postings are read by their bucket, pruned at run time to the buckets of the query's terms; nothing runs while the query
    is built.  ``row_number() <= k`` is planned as a per-task limit before the shuffle on ``query_id``.
    """
    n_docs = F.coalesce(index.stats.select("n_docs").scalar(), F.lit(0)).cast("double")
    total = F.coalesce(index.stats.select("total_len").scalar(), F.lit(0)).cast("double")
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens("text"))).alias("term")).where(F.length("term") > 0)

    def weight(tf: Column, length: Column) -> Column:
        mean = F.col("mean_len")
        norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * length / F.when(mean > 0, mean).otherwise(1.0))
        return F.col("idf") * tf * F.lit(k1 + 1.0) / (tf + norm)

    idf = F.log(F.lit(1.0) + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = asked.join(index.terms, "term").withColumns({"n": n_docs, "mean_len": total / F.greatest(n_docs, F.lit(1.0))}).withColumn("idf", idf)
    floor = F.get(F.filter("floors", lambda f: f["rank"] >= k), F.lit(0))
    terms = terms.withColumns({"most": weight(F.col("max_tf"), F.col("min_len")), "floor": weight(floor["tf"], floor["len"])}).select(
        "query_id", "term", "bucket", "idf", "mean_len", "most", "floor", "df")

    postings = index.postings.select("bucket", "term", "key", "tf", "doc_len")

    def scored(some: DataFrame, only: str = "true", hits: DataFrame = postings) -> DataFrame:
        hits = hits.join(some, ["bucket", "term"]).where(only)
        return hits.select("query_id", "key", weight(F.col("tf"), F.col("doc_len")).alias("part"), "weak")

    def total_score() -> Column:
        return F.round(F.sum("part"), SCORE_DIGITS).alias("score")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("key"))
    # A query has few terms: its windows are small, and there are as many as queries.
    own = Window.partitionBy("query_id")
    weakest = own.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Half a step of the rounding on either side, so that equal rounded scores stay in.
    within = F.sum("most").over(weakest) + 2 * 10.0**-SCORE_DIGITS < F.max("floor").over(own)
    ranked = terms.withColumn("weak", F.coalesce(within, F.lit(False)))
    # Candidates help while they are few against the places below; more would let most documents through.
    few = F.sum(F.when(~F.col("weak"), F.col("df")).otherwise(0)).over(own) <= MAX_CANDIDATES
    ranked = ranked.withColumn("pruned", F.max("weak").over(own) & few)
    ranked = ranked.withColumn("weak", F.col("weak") & F.col("pruned")).drop("df")
    ranked = ranked.withColumn("bar", F.max("floor").over(own) - 2 * 10.0**-SCORE_DIGITS)
    # At most a row for each word of the queries; joins multiply estimates, so the planner would not see that it is small.
    small = planned_bytes(queries) <= MAX_QUERY_BYTES
    if small:
        ranked = F.broadcast(ranked)

    # Candidates as a set of hashes whose size does not depend on their number: what passes by chance is dropped below.
    place = F.pmod(F.xxhash64("query_id", "key"), F.lit(CANDIDATE_PLACES)).cast("int")
    places = scored(ranked, "pruned AND NOT weak").select(place.alias("_mw_place")).distinct().withColumn("_mw_candidate", F.lit(True))
    parts = scored(ranked, "pruned" if small else "true").withColumn("_mw_place", place).join(F.broadcast(places), "_mw_place", "left").where("NOT weak OR _mw_candidate")
    totals = parts.groupBy("query_id", "key").agg(total_score(), F.min("weak").alias("only_weak")).where("NOT only_weak").drop("only_weak")
    if small:
        # Queries without a bar, or with very many candidates, score all documents of their terms: a posting is exchanged once, by document, however many
        # such queries ask for its term, and scored for each of them where the document's other postings are.
        unpruned = ranked.where("NOT pruned")
        once = postings.join(F.broadcast(unpruned.select("bucket", "term").distinct()), ["bucket", "term"], "left_semi")
        once = once.repartition(tasks_for(index.postings), "key")
        # What stays below the bar is out of the result and need not be sorted for it.
        bars = unpruned.groupBy(F.col("query_id").alias("_mw_query")).agg(F.max("bar").alias("_mw_bar")).where("_mw_bar IS NOT NULL")
        whole = scored(F.broadcast(unpruned), hits=once).groupBy("query_id", "key").agg(total_score())
        whole = whole.join(F.broadcast(bars), F.col("query_id").eqNullSafe(F.col("_mw_query")), "left").where("_mw_bar IS NULL OR score >= _mw_bar")
        totals = totals.unionByName(whole.select(*totals.columns))
    return (
        totals
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "key", "score")
    )
