import gzip
import os

import pytest
from pyspark.sql import functions as F

from metaweave.llm import warc
from metaweave.session import scratch_path

PAGES = "page_id long, url string, html string"


def archive(spark, rows, **kw):
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.deduplicated_records(spark.createDataFrame(rows, PAGES), **kw), path)
    return path


def files(path):
    root = path.removeprefix("file://").removeprefix("file:")
    return [f"{root}/{f}" for f in sorted(os.listdir(root)) if f.endswith(".warc.gz")]


def test_round_trip_and_revisits(spark):
    big, other = "<p>ü</p>" * 400, "<b>" + "x" * 5000
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, "http://a/3", other), (4, None, big), (5, "http://a/5", "small"), (6, "http://a/6", "small"), (7, "http://a/7", None)]
    back = {r.record_id: r for r in warc.read_warc(spark, archive(spark, rows)).collect()}
    kinds = {k: r.warc_type for k, r in back.items()}
    assert kinds == {f"<urn:page:{i}>": "revisit" if i in (1, 2) else "response" for i in range(1, 8)}
    assert back["<urn:page:1>"].refers_to == "<urn:page:4>" and back["<urn:page:1>"].payload_length == len(big.encode())
    assert bytes(back["<urn:page:4>"].payload).decode() == big and back["<urn:page:4>"].target_uri is None
    assert bytes(back["<urn:page:7>"].payload) == b"" and back["<urn:page:3>"].payload_length == 5003


def test_files_are_plain_gzip_members(spark):
    (one, *_), data = files(archive(spark, [(1, "http://a", "x" * 2000)])), b""
    with gzip.open(one) as f:
        data = f.read()
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n") and b"Content-Length: 2000" in data


def test_unwanted_payloads_are_not_inflated(spark):
    path = archive(spark, [(i, f"http://a/{i}", f"{i} " + os.urandom(30_000).hex()) for i in range(20)])
    for f in files(path):  # destroy the second half of every member; the headers and the length field stay
        raw, at = bytearray(open(f, "rb").read()), 0
        while at < len(raw):
            total = int.from_bytes(raw[at + 16:at + 20], "little")
            raw[at + total // 2:at + total - 8] = os.urandom(total - total // 2 - 8)
            at += total
        open(f, "wb").write(raw)
    assert warc.read_warc(spark, path, columns=["record_id", "warc_type"]).count() == 20
    assert warc.read_warc(spark, path).where("target_uri = 'none'").count() == 0
    with pytest.raises(Exception, match="zlib|invalid|incorrect"):
        warc.read_warc(spark, path).select(F.sum(F.octet_length("payload"))).collect()


def test_predicates_are_pushed(spark):
    path = archive(spark, [(i, f"http://a/{i % 3}", "y" * (900 + i)) for i in range(30)])
    df = warc.read_warc(spark, path)
    assert df.where("target_uri = 'http://a/1'").count() == 10
    assert df.where("warc_type IN ('response', 'revisit') AND payload_length >= 920").count() == 10
    assert df.where("refers_to IS NOT NULL").count() == 0 and df.where("target_uri LIKE 'http://a/%'").count() == 30
    reader = warc.WarcReader({"path": path}, warc.SCHEMA)
    from pyspark.sql.datasource import EqualTo, StringContains
    kept = [EqualTo(("warc_type",), "response"), StringContains(("target_uri",), "a"), EqualTo(("payload",), b"")]
    assert list(reader.pushFilters(kept)) == kept[1:] and reader.filters == kept[:1]


def test_partitions_split_files_and_foreign_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 2000)
    records = spark.createDataFrame([(i, f"http://a/{i}", os.urandom(400).hex()) for i in range(40)], PAGES).coalesce(1)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.deduplicated_records(records), path)
    reader = warc.WarcReader({"path": path, "maxPartitionBytes": "1"}, warc.SCHEMA)
    parts = reader.partitions()
    assert len(parts) > 3 and sum(b.num_rows for p in parts for b in reader.read(p)) == 40
    plain = b"".join(b"".join(warc._record({"warc_type": "resource", "record_id": f"<r:{i}>", "payload": b"p" * i})) for i in range(5))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(b"".join(warc._record({"warc_type": "resource", "payload": b"q" * 9}))) for _ in range(3)))
    got = warc.read_warc(spark, str(tmp_path))
    assert got.count() == 8 and got.where("payload_length = 9").count() == 3
    assert sorted(bytes(r.payload) for r in got.where("record_id LIKE '<r:%'").collect()) == [b"p" * i for i in range(5)]


def test_append_overwrite_and_empty(spark):
    path = archive(spark, [(1, "u", "a")])
    more = warc.deduplicated_records(spark.createDataFrame([(2, "v", "b")], PAGES))
    warc.write_warc(more, path)
    assert warc.read_warc(spark, path).count() == 2
    warc.write_warc(more, path, mode="overwrite")
    assert [r.target_uri for r in warc.read_warc(spark, path).collect()] == ["v"]
    assert warc.read_warc(spark, archive(spark, [])).count() == 0
    with pytest.raises(Exception, match="not columns of a WARC record"):
        warc.write_warc(spark.range(1), path)


def test_odd_rows(spark):
    big = "z" * 3000
    rows = [(1, "u", big), (1, "u", big), (2, "line\nbreak", big), (2, None, big), (None, "w", big), (None, None, None)]
    back = warc.read_warc(spark, archive(spark, rows)).collect()
    assert len(back) == 6 and sorted(r.warc_type for r in back) == ["response"] * 3 + ["revisit"] * 3
