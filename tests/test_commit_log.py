"""Replay of commit logs: real log files on disk, checkpoint cut-off, gaps, hot tables, odd files."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from metaweave.operators import commit_log as L
from metaweave.sources import commit_log as S

META = pa.struct([("id", pa.string()), ("description", pa.string()), ("format", pa.struct([("provider", pa.string())]))])
ADD = pa.struct([("path", pa.string()), ("size", pa.int64()), ("modificationTime", pa.int64()), ("dataChange", pa.bool_())])


def commit(at, description=None, add=(), remove=()):
    out = [{"commitInfo": {"timestamp": at, "operation": "WRITE", "readVersion": 3}}, {"protocol": {"minReaderVersion": 1}}]
    if description is not None:
        out.append({"metaData": {"id": "x", "description": description, "format": {"provider": "parquet", "options": {}}, "schemaString": "{}"}})
    out += [{"add": {"path": p, "size": size, "modificationTime": at, "dataChange": True}} for p, size in add]
    return out + [{"remove": {"path": p, "deletionTimestamp": at}} for p in remove]


class Log:
    def __init__(self, root, table):
        self.dir = os.path.join(root, table, "_delta_log")
        os.makedirs(self.dir)

    def commit(self, version, *args, **kw):
        with open(f"{self.dir}/{version:020d}.json", "w") as f:
            f.write("\n".join(json.dumps(a) for a in commit(*args, **kw)) + "\n")
        return self

    def checkpoint(self, version, description, adds, part=None, parts=None):
        rows = [{"metaData": {"id": "x", "description": description, "format": {"provider": "parquet"}}, "add": None}] if description is not None else []
        rows += [{"metaData": None, "add": {"path": p, "size": s, "modificationTime": at, "dataChange": False}} for p, s, at in adds]
        number = "" if part is None else f".{part:010d}.{parts:010d}"
        table = pa.table({"metaData": pa.array([r["metaData"] for r in rows], META), "add": pa.array([r["add"] for r in rows], ADD)})
        pq.write_table(table, f"{self.dir}/{version:020d}.checkpoint{number}.parquet")
        return self


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake of + %41 tables")


def replay(spark, root):
    return {r.table_path.rsplit("/", 1)[-1]: r for r in L.replay_commit_log(*S.read_commit_logs(spark, [f"{root}/*"])).collect()}


def test_log_files_of_many_tables(spark, root):
    Log(root, "plain").commit(0, 1000, "first", [("a", 10), ("b", 20)]).commit(1, 2000, "second", [("c", 5)], ["a"]).commit(2, 3500, None, [("a", 7)])
    # Versions before the checkpoint are gone, its own commit is still there; a remove of a file from the checkpoint counts.
    Log(root, "cut off").checkpoint(10, "kept", [("a", 1, 50), ("b", 2, 60)]).commit(10, 9000).commit(11, 9500, None, [("c", 4)], ["b"])
    # An old commit that the checkpoint covers is not replayed again.
    Log(root, "covered").commit(4, 1, "stale", [("old", 99)]).checkpoint(5, "new", [("a", 1, 70)])
    # The later checkpoint lacks a part, so the earlier one counts.
    Log(root, "partial").checkpoint(3, "three", [("a", 3, 30)]).checkpoint(5, "five", [("z", 9, 90)], 1, 2).commit(4, 400, None, [("b", 4)]).commit(5, 500)
    Log(root, "two parts").checkpoint(7, "seven", [("a", 1, 10)], 1, 2).checkpoint(7, None, [("b", 2, 20)], 2, 2)
    Log(root, "gap").commit(0, 1, "d").commit(1, 2).commit(4, 5).commit(5, 6).commit(9, 10)
    Log(root, "late start").commit(2, 1, "d").commit(3, 2)
    Log(root, "no metadata").commit(0, 7, None, [("a", 1)])
    log = Log(root, "noise").commit(0, 1, "ok", [("a b+c%20", 1)])
    for name, text in {"00000000000000000001.crc": "{}", "_last_checkpoint": "{}", "00000000000000000001.compacted.json": '{"add":{"path":"x"}}', "1.json": "{}"}.items():
        with open(f"{log.dir}/{name}", "w") as f:
            f.write(text)
    got = replay(spark, root)

    def seen(name):
        r = got[name]
        return r.base_version, r.version, r.description, r.n_files, r.n_bytes, r.complete

    assert seen("plain") == (None, 2, "second", 3, 32, True) and got["plain"].format == "parquet"
    assert seen("cut off") == (10, 11, "kept", 2, 5, True)
    assert seen("covered") == (5, 5, "new", 1, 1, True)
    assert seen("partial") == (3, 5, "three", 2, 7, True)
    assert seen("two parts") == (7, 7, "seven", 2, 3, True)
    assert seen("gap")[-1] is False and (got["gap"].n_missing, got["gap"].first_missing, got["gap"].last_missing) == (5, 2, 8)
    assert (got["late start"].n_missing, got["late start"].first_missing, got["late start"].last_missing) == (2, 0, 1)
    assert seen("no metadata") == (None, 0, None, 1, 1, False)
    assert seen("noise") == (None, 0, "ok", 1, 1, True)
    assert len(got) == 9 and got["plain"].table_path.endswith("/lake of + %41 tables/plain")
    ms = {k: int(r.last_modified.timestamp() * 1000) for k, r in got.items()}
    assert (ms["plain"], ms["cut off"], ms["covered"], ms["two parts"]) == (3500, 9500, 70, 20)


def test_detail_feeds_the_catalog_only_where_the_log_is_whole(spark, root):
    Log(root, "a").commit(0, 1000, "fine")
    Log(root, "b").commit(1, 1000, "gap")
    replayed = L.replay_commit_log(*S.read_commit_logs(spark, [f"{root}/*"]))
    names = replayed.select("table_path", F.lit("s").alias("schema_name"), F.element_at(F.split("table_path", "/"), -1).alias("table_name"))
    assert [tuple(r)[:4] for r in L.replayed_table_detail(replayed, names, "delta").collect()] == [("s", "a", "delta", "fine")]


def test_landed_lines_and_hot_table(spark):
    """A table with nearly all commits: no window, its commits stay spread over tasks."""
    hot = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("t/hot/_delta_log/"), F.lpad(F.col("id").cast("string"), 20, "0"), F.lit(".json")).alias("file_path"),
        F.concat(F.lit('{"commitInfo":{"timestamp":'), F.col("id").cast("string"), F.lit("}}\n")).alias("line"))
    odd = spark.createDataFrame([("t/x/_delta_log/00000000000000000000.json", "no json"), ("t/x/_delta_log/00000000000000000000.json", None), (None, "{}"),
                                 ("elsewhere.json", "{}"), ("t/x/_delta_log/00000000000000000000.json", '{"metaData":{"description":"d"}}')], "file_path string, line string")
    checkpoints = spark.createDataFrame([], "file_path string, " + S.STATE)
    out = L.replay_commit_log(S.parse_landed_lines(hot.union(odd)), S.checkpoint_rows(checkpoints))
    got = {r.table_path: r for r in out.collect()}
    assert set(got) == {"t/hot", "t/x"} and got["t/hot"].version == 59_999 and got["t/hot"].n_missing == 0
    assert got["t/x"].description == "d" and got["t/x"].last_modified is None
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
