import gzip
import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from usagelens.llm import warc_members

PAGES = "page_id long, url string, html string"


def _want(pages):
    largest = defaultdict(int)
    for key, _, html in pages:
        if key is not None:
            largest[html or ""] = max(largest[html or ""], key)
    rows = []
    for key, _, html in pages:
        body = (html or "").encode()
        alone = len(body) < 1000 or (html or "") not in largest or key == largest[html or ""]
        rows.append((key, len(body), hashlib.sha1(body).hexdigest(), "response" if alone else "revisit",
                     None if alone else largest[html or ""]))
    return Counter(rows)


PAGE = "<p>é \r\n\r\nWARC/1.1 " + "x" * 1200
ROWS = [(1, "http://a", PAGE), (2, "http://b\r\nX: y", PAGE), (9, None, PAGE), (3, "u", "small"), (4, "u", "small"),
        (5, "u", None), (6, "u", ""), (7, "u", "y" * 300_000), (7, "u", "y" * 300_000), (8, "u", "z" * 999),
        (10, "u", "z" * 999)]


@pytest.mark.parametrize("piece", [1 << 18, 7])
def test_round_trip(spark, piece, monkeypatch):
    rows = ROWS if piece > 100 else [r for r in ROWS if len(r[2] or "") < 10_000]
    monkeypatch.setattr(warc_members, "_PIECE", piece)
    out = warc_members.archive_round_trip(spark.createDataFrame(rows, PAGES).repartition(2)).collect()
    assert Counter(tuple(r[f] for f in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
                   for r in out) == _want(rows)


def test_null_ids(spark):
    out = warc_members.archive_round_trip(spark.createDataFrame([(None, None, "a" * 1500), (1, None, "b")], PAGES)).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in out), key=str) == [
        (1, "response", None), (None, "response", None)]


def test_empty_table(spark):
    assert warc_members.archive_round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_one_stream_becomes_one_member_per_record(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, PAGES).coalesce(1)
    archives = warc_members.write_archives(pages, str(tmp_path / "whole")).collect()
    whole = open(archives[0]["file"], "rb").read()
    assert len(archives) == 1 and whole.count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00") == 1
    index = warc_members.normalise(spark.createDataFrame(archives), str(tmp_path / "members")).collect()
    data = open(index[0]["file"], "rb").read()
    assert sum(r["length"] for r in index) == len(data) and len(index) == len(ROWS)
    again = b"".join(gzip.decompress(data[r["offset"]:r["offset"] + r["length"]]) for r in sorted(index, key=lambda r: r["offset"]))
    assert again == gzip.decompress(whole)


def test_archives_are_cut_at_a_size(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "t" * 500) for i in range(10)], PAGES).coalesce(1)
    assert len(warc_members.write_archives(pages, str(tmp_path), archive_bytes=2000).collect()) > 2


def test_cut_off_archives_are_refused(tmp_path):
    path = tmp_path / "cut.warc.gz"
    path.write_bytes(gzip.compress(warc_members.record_header(1, b"u", 50, "0" * 40, None, 50) + b"short"))
    source = warc_members._Stream(warc_members.inflate(str(path)))
    source.header()
    with pytest.raises(ValueError, match="cut off"):
        list(source.body(50))


@pytest.mark.parametrize("partners", [0, 1, 2])
def test_a_null_id_revisits_the_copies_that_have_one(spark, partners):
    rows = [(None, None, PAGE), (None, None, PAGE), *[(i + 1, "u", PAGE) for i in range(partners)]]
    out = warc_members.archive_round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in out) == _want(rows)
    assert {r["record_type"] for r in out if r["page_id"] is None} == {"revisit" if partners else "response"}


def test_other_columns_with_the_same_names(spark):
    pages = spark.createDataFrame([(1, "u", "b", "x", 2, 3, "f"), (2, "u", "c", "x", 2, 3, "f")],
                                  PAGES + ", sha1 string, last int, n int, refers_to string")
    assert [r["refers_to"] for r in warc_members.archive_round_trip(pages).collect()] == [None, None]


def test_archives_are_rewritten_by_many_tasks(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} " * 400) for i in range(200)], PAGES).repartition(2)
    archives = warc_members.write_archives(pages, str(tmp_path / "a"), archive_bytes=5000)
    archives.write.parquet(str(tmp_path / "list"))
    listed = spark.read.parquet(str(tmp_path / "list"))
    index = warc_members.normalise(listed, str(tmp_path / "b"))
    index.write.parquet(str(tmp_path / "index"))
    files = spark.read.parquet(str(tmp_path / "index")).select(F.input_file_name()).distinct().count()
    assert listed.count() >= 20 and files >= spark.sparkContext.defaultParallelism
