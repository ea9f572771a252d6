"""The current graph as a store that batches are merged into.

Nodes lie under ``nodes/label=<label>/bucket=<n>/run=<run>``, edges under ``edges/type=<type>/bucket=<n>/run=<run>``.  The
bucket is a hash of the table a row belongs to (a column's, its edge's or the table's own key up to the table part), so what
is known about a table lies in one bucket of each label and type, a read of one label or type scans its folders only, and a
batch writes only the buckets of its tables anew: the cost of a merge follows the batch, not the graph.

A manifest names the run that holds each bucket.  A merge writes its buckets as a new run and then commits the next manifest
(``sources.versions``): readers see the graph before or after it, never a mix, files of other buckets are not touched, and a
merge that is cut off leaves no trace but unused files.  Of two merges at once the loser sees that its manifest is taken and
merges again on top of the winner's.  Runs that the last manifests do not name are deleted.  A bucket that holds a very large
table is written by many tasks.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.functions.sizing import tasks_for
from metaweave.model import EDGES, NODES
from metaweave.operators.graph import publish_upsert, table_part
from metaweave.session import scratch_path, shuffles_removed
from metaweave.sources.versions import commit_version, delete_folder, read_version, versions

BUCKETS = 64
TAG = "publish_tag"


def bucket_of(key: Column | str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(table_part(key)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class _Kind:
    folder: str
    split: str          # partition column above the bucket
    at: str             # the key that names the bucket
    keys: tuple[str, ...]
    fields: list[str]
    schema: str


NODE_KIND = _Kind("nodes", "label", "key", ("key", "label"), NODES.fieldNames(),
                  "key string, name string, description string, col_type string, sort_order int, is_view boolean, publish_tag string, "
                  "label string, bucket int, run string")
EDGE_KIND = _Kind("edges", "type", "end_key", ("start_key", "end_key", "type"), EDGES.fieldNames(),
                  "start_key string, end_key string, publish_tag string, type string, bucket int, run string")

#: Manifests whose runs are kept for readers that are still at them.
KEEP_VERSIONS = 3


class GraphStore:
    """Nodes and edges below ``root``, a folder that the whole cluster sees; the number of buckets is fixed by the first write."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # -- manifests: {"nodes": {"<label>/<bucket>": run, ...}, "edges": ...} ------------

    @property
    def _versions(self) -> str:
        return f"{self.root}/versions"

    def version(self) -> int:
        """The newest committed version; 0 before the first write."""
        return max(versions(self.spark, self._versions), default=0)

    def _manifest(self, version: int) -> dict[str, dict[str, str]]:
        return json.loads(read_version(self.spark, self._versions, version)) if version else {k.folder: {} for k in (NODE_KIND, EDGE_KIND)}

    def _folder(self, kind: _Kind, place: str, run: str) -> str:
        split, bucket = place.split("/")
        return f"{self.root}/{kind.folder}/{kind.split}={split}/bucket={bucket}/run={run}"

    def _stored(self, kind: _Kind, runs: dict[str, str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], kind.schema)
        paths = [self._folder(kind, place, run) for place, run in sorted(runs.items())]
        return self.spark.read.schema(kind.schema).option("basePath", f"{self.root}/{kind.folder}").parquet(*paths)

    def _read(self, kind: _Kind, version: int | None) -> DataFrame:
        runs = self._manifest(self.version() if version is None else version)[kind.folder]
        return self._stored(kind, runs).select(*kind.fields, TAG)

    def nodes(self, version: int | None = None) -> DataFrame:
        return self._read(NODE_KIND, version)

    def edges(self, version: int | None = None) -> DataFrame:
        return self._read(EDGE_KIND, version)

    # -- merges ---------------------------------------------------------------------------

    def _write(self, kind: _Kind, rows: DataFrame, run: str) -> None:
        # As many parts as the size asks for; beyond the number of buckets each one's rows are cut by a hash of their keys.
        tasks = tasks_for(rows)
        part = F.pmod(F.xxhash64(*kind.keys), F.lit(-(-tasks // self.buckets)))
        with shuffles_removed(self.spark):
            (rows.withColumn("run", F.lit(run)).repartition(tasks, kind.split, "bucket", part).sortWithinPartitions(kind.split, "bucket", *kind.keys)
             .write.mode("append").partitionBy(kind.split, "bucket", "run").parquet(f"{self.root}/{kind.folder}"))

    def _merge(self, kind: _Kind, batch: DataFrame, runs: dict[str, str], tag: str, run: str) -> dict[str, str]:
        """Writes the batch's buckets as ``run``; returns them as places of the manifest."""
        # Labels or types times buckets, whatever the size of the batch.
        places = {f"{r[0]}/{r[1]}": run for r in batch.select(kind.split, "bucket").distinct().collect()}
        if places:
            current = self._stored(kind, {p: r for p, r in runs.items() if p in places}).select(*kind.fields, TAG, "bucket")
            self._write(kind, publish_upsert(current, batch, tag, keys=(*kind.keys, "bucket")), run)
        return places

    def upsert(self, nodes: DataFrame | None, edges: DataFrame | None, tag: str) -> dict[str, list[str]]:
        """Merge a batch of nodes, edges or both (item 21): new and matching keys take its values and ``tag``, all other rows
        stay as they were.  Returns the buckets that were written anew, as ``<label or type>/<bucket>``."""
        given = [(kind, rows) for kind, rows in ((NODE_KIND, nodes), (EDGE_KIND, edges)) if rows is not None]
        batches, paths = [], []
        try:
            for kind, rows in given:
                paths.append(path := scratch_path(self.spark, f"batch-{kind.folder}"))
                with shuffles_removed(self.spark):
                    rows.select(*kind.fields, bucket_of(kind.at, self.buckets).alias("bucket")).write.parquet(path)
                batches.append((kind, self.spark.read.parquet(path)))
            while True:
                version, run = self.version(), uuid.uuid4().hex
                manifest = self._manifest(version)
                written = {kind.folder: self._merge(kind, rows, manifest[kind.folder], tag, run) for kind, rows in batches}
                merged = {folder: {**runs, **written.get(folder, {})} for folder, runs in manifest.items()}
                if not any(written.values()) or commit_version(self.spark, self._versions, version + 1, json.dumps(merged)):
                    break
                for kind, _ in batches:  # another merge was faster: this one's buckets may lack its rows
                    self._delete(kind, written[kind.folder])
        finally:
            for path in paths:  # the rows are in their buckets, or the merge was cut off
                delete_folder(self.spark, path)
        self._clean(version + 1)
        return {folder: sorted(places) for folder, places in written.items()}

    def _delete(self, kind: _Kind, places: dict[str, str]) -> None:
        for place, run in places.items():
            delete_folder(self.spark, self._folder(kind, place, run))

    def _clean(self, version: int) -> None:
        """Deletes what only the manifest before the kept ones names."""
        old = version - KEEP_VERSIONS
        if old < 1:
            return
        kept = [self._manifest(v) for v in versions(self.spark, self._versions) if v > old]
        for kind in (NODE_KIND, EDGE_KIND):
            gone = set(self._manifest(old)[kind.folder].items()) - {x for m in kept for x in m[kind.folder].items()}
            self._delete(kind, dict(gone))

    def create(self, nodes: DataFrame, edges: DataFrame, tag: str) -> GraphStore:
        """The store's first content: a merge into nothing."""
        self.upsert(nodes, edges, tag)
        return self
