"""Archives and audits against plain forms."""

import hashlib

import pytest
from pyspark.sql import functions as F

from klaxon.llm import warc


def pages(spark, number=300):
    rows = [(i, f"http://x/{i}", f"<p>{'text é ' * (i % 50)}{i}</p>", 1) for i in range(number)]
    rows += [(None, None, None, 1), (5, "http://a\nb", "", 1), (5, "http://a\nb", "", 1)]
    rows += [(1000, "http://long", "x" * 300_000, 1)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, shard int")


@pytest.fixture
def archive(spark, tmp_path):
    warc.write_archive(pages(spark).repartition(3), str(tmp_path / "a"))
    return spark.read.parquet(str(tmp_path / "a"))


def test_records_put_together_are_files(archive):
    files = {}
    for row in archive.orderBy("shard", "offset").collect():
        data = files.get(row["shard"], b"")
        assert row["offset"] == len(data) and row["length"] == len(row["record"])
        files[row["shard"]] = data + bytes(row["record"])
    seen = 0
    for data in files.values():
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n")
            size = int(lines[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, seen = rest[size + 4 :], seen + 1
    assert seen == 304


def test_equal_replicas(archive):
    assert warc.audit(archive, archive).isEmpty()
    assert warc.audit(archive.limit(0), archive.limit(0)).isEmpty()


def test_damage_is_located(spark, archive, tmp_path):
    flipped = F.concat(F.substring("record", 1, 20), F.lit(b"?"), F.substring("record", 22, 1 << 30))
    short = F.substring("record", 1, 30)
    where = F.col("page_id")
    damaged = archive.filter("page_id IS NULL OR page_id NOT IN (17, 150)").withColumn(
        "record", F.when(where == 42, flipped).when(where == 1000, short).otherwise(F.col("record"))
    )
    extra = spark.createDataFrame([(0, 10_000_000, 3, 7, bytearray(b"new"))], warc.ARCHIVE)
    damaged.unionByName(extra).write.parquet(str(tmp_path / "b"))
    found = warc.audit(archive, spark.read.parquet(str(tmp_path / "b"))).collect()
    assert {(r["page_id"], r["finding"]) for r in found} == {
        (17, "missing"), (150, "missing"), (42, "changed"), (1000, "changed"), (7, "extra")
    }
    places = {r["page_id"]: r for r in archive.collect()}
    for row in found:
        if row["finding"] != "extra":
            place = places[row["page_id"]]
            assert (row["shard"], row["offset"], row["length"]) == place[:3]
            assert row["digest"] == hashlib.sha256(place["record"]).hexdigest()


def test_a_replica_without_records(archive):
    found = warc.audit(archive, archive.limit(0))
    assert found.count() == 304 and found.filter("finding != 'missing'").isEmpty()


def test_only_branches_that_differ_are_descended(spark, archive, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 2048)
    monkeypatch.setattr(warc, "FANOUT", 4)
    damaged = archive.withColumn(
        "record", F.when(F.col("page_id") == 42, F.lit(b"x")).otherwise(F.col("record"))
    )
    sizes = []
    plain = warc._below
    monkeypatch.setattr(warc, "_below", lambda *a: (lambda df: (sizes.append(df.count()), df)[1])(plain(*a)))
    found = warc.audit(archive, damaged).collect()
    assert [(r["page_id"], r["finding"]) for r in found] == [(42, "changed")]
    assert len(sizes) > 4 and max(sizes) <= 16
