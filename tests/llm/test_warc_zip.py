import base64
import hashlib
import io
import zipfile
import zlib

import pytest
from pyarrow import BufferReader
from pyspark.sql import functions as F

from quillwork.llm import warc_zip as wz
from quillwork.session import new_folder

LONG = "x" * 400 + "é漢" * 200
ROWS = [
    (1, "http://a.example/1", LONG), (7, "http://b.example/2?q=ü", LONG), (3, None, LONG), (None, "http://c.example/", LONG),
    (4, "http://a.example/\r\nWARC-Type: evil x", "short"), (5, "", "short"), (6, "http://[bad", None), (8, "u", ""),
    (9, "http://a.example/9", "y" * 999), (10, "http://a.example/10", "y" * 999), (11, "v", "z" * 1000), (12, "v", "z" * 1000),
    (13, "w", "\r\n\r\nWARC/1.1\r\nHTTP/1.1 " * 100), (14, "t", "t" * 2000), (14, "t", "t" * 2000), (2, "t", "t" * 2000),
    (20, "big", "long page " * 300_000),
]


def brute(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        top = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        again = len(payload) >= 1000 and page_id != top
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "same": F.lit("clash"), "n": F.lit(2)})


def result(records):
    return sorted(
        ((None if r["page_id"] is None else int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
          None if r["response_page"] is None else int(r["response_page"])) for r in wz.resolved(records).collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"archive_bytes": 200, "member_bytes": 100}, {"archive_records": 3, "member_bytes": 1}])
def test_round_trip(spark, sizes):
    pages = frame(spark)
    archives = wz.write_archives(wz.captures(pages.repartition(3)), new_folder(spark, "warc"), **sizes)
    assert sum(r["records"] for r in archives.collect()) == len(ROWS)
    records = wz.read_records(wz.list_records(archives))
    assert result(records) == brute(ROWS)
    read = wz.resolved(records, "payload").collect()
    assert sorted(((r["page_id"], bytes(r["payload"])) for r in read), key=str) == sorted(
        ((None if p is None else str(p), (h or "").encode()) for p, _, h in ROWS), key=str)
    assert all(r["verified"] in (True, None) for r in read)
    assert {r["url"] for r in read} >= {"http://b.example/2?q=ü", "http://a.example/%0D%0AWARC-Type:%20evil%20x", ""}


def test_empty_table(spark):
    archives = wz.write_archives(wz.captures(frame(spark).limit(0)), new_folder(spark, "warc"))
    assert archives.count() == 0 and wz.resolved(wz.read_records(wz.list_records(archives))).collect() == []


def a_record(k, text=b"hello"):
    return wz.warc_record(k, f"http://x.example/{k}", text, f"<urn:uuid:{k}>", None)[0]


def an_archive(parts, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in parts:
            with z.open(name, "w", force_zip64=True) as member:
                member.write(data)
        z.comment = comment
    return out.getvalue()


PACKED = [zlib.compress(a_record(k, b"p%d" % k * 50), wbits=31) for k in range(20)]
PARTS = [("datapackage.json", b"{}"), ("archive/a.warc.gz", b"".join(PACKED)), ("archive/b.warc", b"".join(a_record(k, b"q" * k) for k in range(30, 40)))]


def read_back(spark, folder, data, name="z.wacz"):
    (folder / name).write_bytes(data)
    places = wz.list_records(spark.createDataFrame([(str(folder / name),)], "path string"))
    return sorted((int(r["page_id"]), bytes(r["payload"])) for r in wz.read_records(places).collect())


WANT = sorted([(k, b"p%d" % k * 50) for k in range(20)] + [(k, b"q" * k) for k in range(30, 40)])


@pytest.mark.parametrize("front,comment", [(b"", b""), (b"#!/bin/sh\n" * 9, b""), (b"", b"a comment PK\5\6 that looks like an end" * 3)])
@pytest.mark.parametrize("wide", [False, True])
def test_foreign_archives(spark, tmp_path, monkeypatch, front, comment, wide):
    if wide:  # every size, place and count moves into ZIP64 records
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 1)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = an_archive(PARTS, comment)
    assert (b"PK\6\6" in data) == wide
    members = {m.name: m for m in wz.members_of(BufferReader(front + data), len(front + data), piece=50)}
    assert {n: m.size for n, m in members.items()} == {n: len(d) for n, d in PARTS} and all(m.stored for m in members.values())
    file = BufferReader(front + data)
    for name, held in PARTS:
        assert file.read_at(len(held), wz.data_begin(file, members[name])) == held
    assert read_back(spark, tmp_path, front + data) == WANT


def test_an_index_rules_and_what_it_leaves_is_walked(spark, tmp_path):
    begin, lines = 0, []
    for k, packed in enumerate(PACKED):
        if k % 2:
            lines.append(b'com,x)/%d 2000 {"filename": "a.warc.gz", "offset": "%d", "length": %d}' % (k, begin, len(packed)))
        begin += len(packed)
    data = an_archive([*PARTS, ("indexes/index.cdxj", b"\n".join(lines))])
    assert read_back(spark, tmp_path, data) == [w for w in WANT if w[0] % 2 or w[0] >= 30]
    many = {f"archive/{k}.warc": a_record(k) for k in range(70_000, 70_003)}
    filler = [(f"f{k}", b"") for k in range(66_000)]  # more entries than 16 bits count
    data = an_archive([*filler, *many.items()])
    assert b"PK\6\6" in data and read_back(spark, tmp_path, data, "many.wacz") == [(k, b"hello") for k in range(70_000, 70_003)]


def test_what_is_no_archive_is_an_error(spark, tmp_path):
    whole = an_archive(PARTS)
    for data in (b"", b"PK", whole[:-30], whole[: len(whole) // 2]):
        with pytest.raises(ValueError):
            list(wz.members_of(BufferReader(data), len(data)))
    with pytest.raises(Exception, match="is not stored"):
        read_back(spark, tmp_path, an_archive(PARTS, method=zipfile.ZIP_DEFLATED))
    listed = wz.list_members(spark.createDataFrame([(str(tmp_path / "z.wacz"),)], "path string")).collect()
    assert [(r["name"], r["stored"]) for r in listed] == [(n, False) for n, _ in PARTS]


def test_digests_in_both_spellings():
    plain = hashlib.sha1(b"a").hexdigest()
    packed = base64.b32encode(bytes.fromhex(plain)).decode()
    assert [wz.hex_digest(told) for told in ("sha1:" + plain.upper(), "SHA1:" + packed, None, "md5:00")] == [plain, plain, None, None]
