"""Archives written and read back, broken ones, and ones that other tools could have written."""

from __future__ import annotations

import hashlib
import pathlib
import struct

import pytest
import zstandard

from daybook.llm import warc

PAGES = "page_id long, url string, html string, payload string, digest string, frame string"
LONG = "<p>" + "long é漢😀 " * 300_000


def page_rows():
    shared = "<html>" + "shared by many " * 20
    rows = [(i, f"https://example.org/{i}?q=a b", shared if i % 3 == 0 else f"<p>{i}</p>" * (i % 40)) for i in range(5, 400)]
    rows += [(1, None, None), (2, "", ""), (3, "http://x\r\nWARC-Type: y", "short"), (4, "u", "short")]
    rows += [(None, "null id", shared), (None, "a", "z" * 100), (None, "b", "z" * 100), (500, "c", LONG), (501, "d", LONG)]
    rows += [(6, "twice", shared), (6, "twice", shared), (0, "0", "y" * 99), (-1, "-1", "y" * 99), (-7, "é", "y" * 100), (9000, "x", "y" * 100)]
    return rows


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html] = min(first.get(html, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        target = first.get(html) if len(data) >= 100 else page_id
        target = None if target == page_id else target
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if target is None else "revisit", target))
    return sorted(out, key=str)


def read_back(spark, path, **options):
    records = warc.read_warc(spark, path, **options)
    pages = records.where("record_type <> 'warcinfo'").withColumns(
        {"page_id": warc.page_id("record_id"), "target": warc.page_id("refers_to")}
    )
    return pages.collect(), records


@pytest.mark.parametrize("file_bytes", [warc.FILE_BYTES, 2000])
def test_round_trip(spark, tmp_path, monkeypatch, file_bytes):
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    rows = page_rows()
    pages = spark.createDataFrame([(*x, "p", "d", "f") for x in rows], PAGES)
    warc.write_warc(pages, str(tmp_path / "out"))
    found, records = read_back(spark, str(tmp_path / "out"))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.target) for r in found), key=str) == expected(rows)
    html = {(page_id, url): html for page_id, url, html in rows}
    for r in found:
        if r.record_type == "response" and r.url == f"https://example.org/{r.page_id}?q=a%20b":
            assert bytes(r.payload).decode() == html[(r.page_id, r.url.replace("%20", " "))]
    assert {r.url for r in found if r.page_id == 3} == {"http://x%0D%0AWARC-Type:%20y"}
    assert [r.url for r in found if r.page_id == 1] == [None]
    assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    assert warc.dangling(records).isEmpty()
    assert warc.dangling(records.where("record_id <> '<urn:daybook:page:6>'")).count() == 1
    files = [p.read_bytes() for p in pathlib.Path(tmp_path / "out").rglob("part-*")]
    assert len(files) > (20 if file_bytes == 2000 else 0)
    for data in files:
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC
        # any Zstandard reader takes the file
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True)
        assert reader.read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_no_pages_and_no_dictionary(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 200, "", "", "")], PAGES)
    warc.write_warc(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0
    warc.write_warc(pages, str(tmp_path / "one"))
    found, _ = read_back(spark, str(tmp_path / "one"), payloads=False)
    assert [(r.page_id, r.payload, r.payload_bytes) for r in found] == [(1, None, 200)]
    files = list(pathlib.Path(tmp_path / "one").rglob("part-*"))
    assert files[0].read_bytes().startswith(warc.FRAME_MAGIC)


RECORD = warc.page_record(7, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, "2024-01-01T00:00:00Z")


@pytest.mark.parametrize(
    "old, new, problem",
    [
        (b"WARC/1.1", b"WARC/9", "no WARC header"),
        (b"WARC-Date", b"WARC-Data", "warc-date is missing"),
        (b"WARC-Type: response", b"no colon", "without a name"),
        (b"WARC-Type: response", b"WARC-Type: revisit", "refers to a record"),
        (b"Content-Length: 7\r\n", b"Content-Length: 9\r\n", "not the one stated"),
        (b"Content-Length: 7\r\n", b"Content-Length: x\r\n", "not a number"),
        (b"payload\r\n", b"payloads\r\n", "that of the block"),
        (b"payload\r\n", b"paylaod\r\n", "digest"),
        (b"HTTP/1.1", b"PTTH/1.1", "no HTTP header"),
        (b"sha256:", b"sha1:", "no SHA-256"),
        (b"\r\n\r\n", b"", "no WARC header"),
    ],
)
def test_broken_records(spark, tmp_path, old, new, problem):
    assert warc.parsed(RECORD)["payload"] == b"payload"
    broken = RECORD.replace(old, new)
    assert broken != RECORD
    with pytest.raises(warc.Broken, match=problem):
        warc.parsed(broken)
    pack = zstandard.ZstdCompressor().compress
    (tmp_path / "x.warc.zst").write_bytes(pack(RECORD) + pack(broken) + pack(RECORD))
    found = warc.read_warc(spark, str(tmp_path), strict=False).collect()
    assert [r.problem is None for r in found] == [True, False, True]
    with pytest.raises(Exception, match=problem):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_broken_archives(spark, tmp_path):
    pack = zstandard.ZstdCompressor().compress
    whole = pack(RECORD)
    plain = struct.pack("<II", warc.DICTIONARY_MAGIC, 16) + b"sixteen bytes ok"
    noise = struct.pack("<II", warc.SKIPPABLE[5], 3) + b"abc"
    for name, data, good, bad in [
        ("cut", whole + whole[:-3], 1, 1),
        ("noise", noise + whole + noise + whole, 2, 0),
        ("garbage", whole + b"garbage", 1, 1),
        ("skip", whole + noise[:-1], 1, 1),
        ("raw dictionary", plain + whole, 1, 0),
        ("empty", b"", 0, 0),
    ]:
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a").write_bytes(data)
        found = warc.read_warc(spark, str(folder), strict=False).collect()
        assert (sum(r.problem is None for r in found), sum(r.problem is not None for r in found)) == (good, bad), name
