import base64
import gzip
import hashlib
import io
import os
import random
import struct

import pytest
import zstandard

from dossier.llm import warc
from dossier.llm.queries import op5_warc
from dossier.llm.warc import ArchiveError, digest, encode_record, parse_page, parse_record, read_archive, read_records
from tests.llm.util import prose

SF = "/root/testdata/sf0.001"


def pages_of(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id bigint, url string, html string, offset int, payload string")


def expected(rows):
    """The contract's rows by brute force; rows without an id are responses."""
    last = {}
    for page_id, html in rows:
        if page_id is not None:
            last[html or ""] = max(page_id, last.get(html or "", page_id))
    found = []
    for page_id, html in rows:
        payload = (html or "").encode()
        refers = last.get(html or "") if page_id is not None else None
        kind = "response" if refers in (None, page_id) else "revisit"
        sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        found.append((page_id, len(payload), sha1, kind, refers if kind == "revisit" else None))
    return sorted(found, key=repr)


def columns(df):
    chosen = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def test_round_trip_of_odd_rows(spark, tmp_path, monkeypatch):
    rnd = random.Random(1)
    rows = [(i, f"http://h/{i}", prose(rnd, 80)) for i in range(300)]
    rows += [(1000 + i, None, rows[i][2]) for i in range(0, 300, 7)] + [(2000 + i, "http://hot/", "hot page") for i in range(200)]
    rows += [(3000, "u", None), (3001, "u", ""), (None, "http://none", "no id"), (None, None, "no id"), (5, "http://h/5", rows[5][2])]
    rows += [(-7, "http://a b\r\nX: y/é", "negative"), (4000, "u", "x" * 3_000_000), (4001, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (4001, "u", "other")]
    df = pages_of(spark, *[(*r, 1, "clash") for r in rows]).repartition(4)
    archives = warc.write_archives(warc.with_revisits(df), str(tmp_path / "whole"))
    read = warc.read_archives(archives)
    assert columns(read) == expected([(i, html) for i, _, html in rows])
    found = read.collect()
    assert all(r.error is None for r in found)
    by_kind = {(r.page_id, r.payload_digest): r for r in found}
    for page_id, url, html in rows:
        row = by_kind[page_id, digest((html or "").encode())]
        if row.record_type == "response":
            assert row.payload == bytearray((html or "").encode())
        if page_id in (7, 3000):
            assert row.url == url
    assert by_kind[-7, digest(b"negative")].url == "http://a%20b%0D%0AX:%20y/é"
    assert sum(r.records for r in archives.collect()) == len(rows)


def test_archives_are_closed_when_full(spark, tmp_path, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, "u", prose(rnd, 300), 1, "") for i in range(600)]
    writer = warc._Writer(str(tmp_path))
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    for page_id, url, html, *_ in rows:
        writer.add(encode_record(page_id, url, html.encode(), None))
    writer.close()
    assert len(writer.finished) > 2 and len(os.listdir(tmp_path)) == len(writer.finished)
    assert [r["page_id"] for path, _, _ in writer.finished for r in read_archive(path)] == list(range(600))


def test_a_dictionary_leads_the_archive(tmp_path):
    rnd = random.Random(3)
    writer = warc._Writer(str(tmp_path))
    for i in range(300):
        writer.add(encode_record(i, "http://h/", ("<html><body>" + prose(rnd, 40)).encode(), None))
    writer.close()
    with open(writer.finished[0][0], "rb") as file:
        data = file.read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 1000
    plain = [text for _, text in read_records(io.BytesIO(data))]
    assert len(plain) == 300
    # The frames cannot be read without it.
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(data[8 + size :], max_output_size=1 << 20)
    # The dictionary may be stored compressed.
    learnt = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    packed = struct.pack("<II", magic, len(learnt)) + learnt + data[8 + size :]
    assert [text for _, text in read_records(io.BytesIO(packed), chunk=7)] == plain


def archive(tmp_path, *records, name="a"):
    path = str(tmp_path / f"{name}.warc.zst")
    with open(path, "wb") as file:
        for record in records:
            file.write(zstandard.ZstdCompressor().compress(record))
    return path


GOOD = encode_record(1, "http://h/", b"payload", None)


@pytest.mark.parametrize(
    ("broken", "message"),
    [
        (GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (GOOD.replace(b"WARC-Date", b"X-Date"), "warc-date is missing"),
        (GOOD.replace(b"\r\nContent-Length: 9", b"\r\nContent-Length: -9", 1), "no number"),
        (GOOD[:-1], "bytes where"),
        (GOOD + b"x", "bytes where"),
        (GOOD + GOOD, "bytes where"),
        (GOOD.replace(b"payload\r\n", b"Payload\r\n"), "block does not match"),
        (GOOD.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Type: response"), "twice"),
        (GOOD.replace(b"WARC-Type: response", b"WARC-Type: metadata"), "type metadata"),
        (GOOD.replace(b"WARC-Type: response", b"WARC-Type: response\r\nnonsense"), "without a name"),
        (GOOD.replace(b"WARC-Payload-Digest", b"X-Digest"), "no digest"),
    ],
)
def test_unsound_records_are_named(tmp_path, broken, message):
    if message == "no number":
        head, _, rest = GOOD.rpartition(b"Content-Length: ")
        broken = GOOD.replace(b"Content-Length: " + GOOD.split(b"Content-Length: ")[1].split(b"\r\n")[0], b"Content-Length: -9", 1)
    path = archive(tmp_path, GOOD, broken, GOOD)
    with pytest.raises(ArchiveError, match=message):
        list(read_archive(path))
    found = list(read_archive(path, strict=False))
    assert [r["error"] is None for r in found] == [True, False, True] and message in found[1]["error"]


def test_broken_files(tmp_path):
    whole = archive(tmp_path, GOOD, GOOD)
    with open(whole, "rb") as file:
        data = file.read()
    for name, cut in (("short", data[:-3]), ("noise", data + b"noise noise noise"), ("gzip", gzip.compress(GOOD)), ("lead", struct.pack("<II", 0x184D2A5D, 99) + b"x")):
        path = str(tmp_path / f"{name}.warc.zst")
        with open(path, "wb") as file:
            file.write(cut)
        with pytest.raises(ArchiveError):
            list(read_archive(path))
        assert list(read_archive(path, strict=False))[-1]["error"]
    empty = str(tmp_path / "empty.warc.zst")
    open(empty, "wb").close()
    assert list(read_archive(empty)) == []


def test_a_revisit_has_headers_only():
    headers, block = parse_record(encode_record(1, None, b"payload", 9))
    page = parse_page(headers, block)
    assert (page["record_type"], page["refers_to"], page["payload_bytes"], page["payload"], page["url"]) == ("revisit", 9, 7, None, None)
    with pytest.raises(ArchiveError, match="revisit"):
        parse_page({**headers, "warc-refers-to": "<urn:page:none>"}, block)


def test_errors_travel_as_rows(spark, tmp_path):
    path = archive(tmp_path, GOOD, GOOD[:-1])
    named = spark.createDataFrame([(path,)], "archive string")
    assert sorted(r.error is None for r in warc.read_archives(named, strict=False).collect()) == [False, True]


def test_empty_table(spark):
    assert warc.round_trip(spark, pages_of(spark)).count() == 0


def test_query_against_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert columns(op5_warc(spark, SF)) == expected(rows)


def test_archives_are_dealt_to_tasks_by_their_bytes(spark):
    from dossier.llm.warc import _readers

    rows = spark.range(5000).selectExpr("concat('a', id) AS archive", "1L AS records", "67108864L AS bytes")
    assert _readers(rows) == 5000 and _readers(rows.limit(40)) == 40
    assert _readers(rows.withColumn("bytes", rows.records)) == spark.sparkContext.defaultParallelism
    assert _readers(rows.select("archive")) == 5000 and _readers(rows.limit(0)) == 1
    read = rows.select("archive").repartition(_readers(rows))
    assert read.rdd.getNumPartitions() == 5000
