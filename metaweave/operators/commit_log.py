"""Item 4 over the logs themselves: table details by replay of commits on top of the latest complete checkpoint.

* **Cut-off.**  A checkpoint counts when all of its parts are there; the latest such one of a table is its base.  Commits up
  to it are not replayed, whether or not their files still exist.
* **Replay.**  The last metadata action wins.  A data file is live when the last action on its path added it.
* **Gaps.**  Versions must follow one another from the base (or from 0) up to the newest; what is missing is counted and its
  first and last version told.  A table with a gap, or without metadata, is not ``complete``.

Every step is an aggregate with map-side combine, keyed by table, by (table, version) or by (table, path): no window and no
list holds a table's log, so a table with most of all commits is shared by many tasks.  The only join is of the commits
with their table's base version, one row a table.  Files that cannot be read as logs, and null actions, take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.model import TABLE_KEYS
from metaweave.session import materialize

KEY = "table_path"


def base_versions(checkpoints: DataFrame) -> DataFrame:
    """``(table_path, base)``: the version of each table's latest checkpoint that has all of its parts."""
    # A writer may leave checkpoints of different part counts at one version: each count is a checkpoint of its own.
    whole = checkpoints.groupBy(KEY, "version", "parts").agg(F.countDistinct("part").alias("there")).where(F.col("there") == F.col("parts"))
    return whole.groupBy(KEY).agg(F.max("version").alias("base"))


def _base_state(checkpoints: DataFrame, base: DataFrame) -> DataFrame:
    """Checkpoint rows of the base versions; repeated rows of several writers do no harm, as the last action per path counts."""
    return checkpoints.join(base, KEY).where(F.col("version") == F.col("base")).select(
        KEY, "version", "metaData", "add", "remove", F.lit(None).cast("struct<timestamp:bigint,operation:string>").alias("commitInfo"))


def _gaps(commits: DataFrame, base: DataFrame) -> DataFrame:
    """``(table_path, n_missing, first_missing, last_missing)`` for tables whose versions do not follow one another."""
    # The base, or the place before version 0, counts as there.
    have = commits.select(KEY, "version").union(base.select(KEY, "base")).union(commits.select(KEY, F.coalesce("base", F.lit(-1).cast("long"))))
    marks = F.array(
        F.struct(F.col("version").alias("version"), F.lit(True).alias("there"), F.lit(False).alias("before"), F.lit(False).alias("after")),
        F.struct((F.col("version") - 1).alias("version"), F.lit(False).alias("there"), F.lit(True).alias("before"), F.lit(False).alias("after")),
        F.struct((F.col("version") + 1).alias("version"), F.lit(False).alias("there"), F.lit(False).alias("before"), F.lit(True).alias("after")))
    places = have.select(KEY, F.inline(marks)).groupBy(KEY, "version").agg(
        F.max("there").alias("there"), F.max("before").alias("before"), F.max("after").alias("after"))
    # The place below the lowest version and the one above the highest are missing for every table.
    spans = places.groupBy(KEY).agg(
        F.min(F.when(F.col("there"), F.col("version"))).alias("low"), F.max(F.when(F.col("there"), F.col("version"))).alias("high"),
        F.count_if("there").alias("n"),
        F.min(F.when(~F.col("there") & F.col("after"), F.col("version"))).alias("first_missing"),
        F.max(F.when(~F.col("there") & F.col("before"), F.col("version"))).alias("last_missing"))
    n = F.col("high") - F.col("low") + 1 - F.col("n")
    return spans.where(n > 0).select(KEY, n.alias("n_missing"), "first_missing", "last_missing")


def replay_commit_log(commits: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """One row per table that has a commit or a complete checkpoint:

    ``table_path``, ``base_version`` (null without a checkpoint), ``version``, ``last_modified`` (time of the newest commit;
    without its file, of the newest data file), ``format``, ``description``, ``n_files``, ``n_bytes`` (live data files),
    ``n_missing``, ``first_missing``, ``last_missing`` and ``complete``.  The inputs are those of ``sources.commit_log``.
    """
    base = materialize(base_versions(checkpoints), "log-base")  # read by every branch below
    later = commits.join(base, KEY, "left").where(F.col("base").isNull() | (F.col("version") >= F.col("base")))
    replayed = later.where(F.col("base").isNull() | (F.col("version") > F.col("base")))
    columns = [KEY, "version", "metaData", "add", "remove", "commitInfo"]
    state = _base_state(checkpoints, base).select(*columns).union(replayed.select(*columns))
    # The base's own commit file, where it still exists, tells only when it was made.
    times = later.where(F.col("version") == F.col("base")).select(
        KEY, "version", *[F.lit(None).cast(state.schema[c].dataType).alias(c) for c in ("metaData", "add", "remove")], "commitInfo")
    facts = state.union(times).groupBy(KEY).agg(
        F.max("version").alias("version"),
        F.max_by(F.struct("metaData.format.provider", "metaData.description"), F.when(F.col("metaData").isNotNull(), F.col("version"))).alias("m"),
        F.max(F.when(F.col("commitInfo.timestamp").isNotNull(), F.struct("version", "commitInfo.timestamp"))).alias("made"),
        F.max("add.modificationTime").alias("written"))
    path = F.coalesce("add.path", "remove.path")
    files = state.where(path.isNotNull()).groupBy(KEY, path.alias("path")).agg(
        F.max(F.struct("version", F.col("add").isNotNull().alias("live"), F.coalesce("add.size", F.lit(0)).alias("size"))).alias("last"))
    live = files.groupBy(KEY).agg(F.count_if("last.live").alias("n_files"),
                                  F.sum(F.when(F.col("last.live"), F.col("last.size")).otherwise(0)).alias("n_bytes"))
    made = F.coalesce(F.when(F.col("made.version") == F.col("version"), F.col("made.timestamp")), F.col("written"), F.col("made.timestamp"))
    missing = F.coalesce("n_missing", F.lit(0).cast("long"))
    return (
        facts.join(base, KEY, "left").join(live, KEY, "left").join(_gaps(replayed, base), KEY, "left")
        .select(KEY, F.col("base").alias("base_version"), "version", F.timestamp_millis(made).alias("last_modified"),
                F.col("m.provider").alias("format"), F.col("m.description").alias("description"),
                F.coalesce("n_files", F.lit(0).cast("long")).alias("n_files"), F.coalesce("n_bytes", F.lit(0).cast("long")).alias("n_bytes"),
                missing.alias("n_missing"), "first_missing", "last_missing", (F.col("m").isNotNull() & (missing == 0)).alias("complete"))
    )


def replayed_table_detail(replayed: DataFrame, table_paths: DataFrame, table_format: str | None = None) -> DataFrame:
    """Replayed details in the shape of ``raw_table_detail``, for ``lake_catalog(..., table_detail=...)``.

    ``table_paths`` maps ``table_path`` to ``schema_name``, ``table_name``.  A table whose log is not complete has no detail.
    The log names the format of the data files; ``table_format`` names the table's own instead.
    """
    fmt = F.col("format") if table_format is None else F.lit(table_format)
    return replayed.where("complete").join(table_paths.select(KEY, *TABLE_KEYS), KEY).select(
        *TABLE_KEYS, fmt.alias("format"), "description", "last_modified")
