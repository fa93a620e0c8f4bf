import base64
import hashlib
import io
import os

import pytest

from llm import archive
from llm.common import pages

SCHEMA = "page_id long, url string, html string, record_id string, n long"
ROWS = [
    (5, "http://a.example/x y", "same"), (3, None, "same"), (9, "http://b.example/", None), (2, "", ""), (7, "u", "é😀\r\n\r\nWARC/1.1\r\n"),
    (7, "u", "é😀\r\n\r\nWARC/1.1\r\n"), (None, "n", "same"), (None, "m", "only\n"), (8, "big", "line\n" * 60_000), (1, "tab\there", "\x00\x85"),
]


def sha(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def brute(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    seen, out = set(), []
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        t = html or ""
        repeat = t in seen and len(t.encode()) >= least
        seen.add(t)
        out.append((i, len(t.encode()), sha(t), "revisit" if repeat else "response", first.get(t) if repeat else None))
    return sorted(out, key=str)


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("least", [0, 5])
def test_odd_rows(spark, least):
    got = archive.archived_pages(table_of(spark, ROWS).repartition(3), least).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(ROWS, least)


def test_empty_table(spark):
    assert archive.archived_pages(table_of(spark, [])).count() == 0


def test_whole_table(spark, folder):
    df = pages(spark, folder)
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    assert sorted([tuple(r) for r in archive.archived_pages(df).collect()], key=str) == brute(rows)


@pytest.mark.parametrize("version", [1, 2])
def test_records_are_read_by_their_length(version):
    body = b"HTTP/1.1 200 OK\r\n\r\nhttp://x 1 2 3 4\n\n"
    block = archive.version_block(version, "t.arc")
    text = block.encode() + b"\n"
    for k in range(2):
        text += archive.arc_header(version, f"http://h/{k}", len(body), 0, "t.arc", "-").encode() + b"\n" + body + b"\n"
    got = list(archive.read_arc(io.BytesIO(text)))
    assert [r["URL"] for r in got] == ["http://h/0", "http://h/1"] and all(r["body"] == body for r in got)
    assert text[got[1]["offset"] :].startswith(b"http://h/1") and got[0]["archive"] == "t.arc"
    with pytest.raises(ValueError, match="inside a record"):
        list(archive.read_arc(io.BytesIO(text[:-9])))
    with pytest.raises(ValueError, match="header fields"):
        list(archive.read_arc(io.BytesIO(text + b"http://h too few\n")))
    with pytest.raises(ValueError, match="version"):
        list(archive.read_arc(io.BytesIO(text.replace(b"%d 0 pages" % version, b"7 0 pages"))))
    with pytest.raises(ValueError, match="version block"):
        list(archive.read_arc(io.BytesIO(b"http://h/0 ...\n")))


def test_records_of_the_format(spark, tmp_path):
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    archive.write_arc(table_of(spark, ROWS).repartition(2), arc)
    archive.convert(spark, arc, warc)
    import gzip

    ids = []
    for name in sorted(os.listdir(warc)):
        if name.startswith("part-"):
            with gzip.open(f"{warc}/{name}") as f:
                records = list(archive.read_warc(f))
            assert records[0][0]["warc-type"] == "warcinfo"
            for fields, block in records[1:]:
                ids.append(fields["warc-record-id"])
                assert fields["warc-date"] == "2024-01-01T00:00:00Z" and fields["warc-target-uri"]
                assert len(block) == int(fields["content-length"])
                assert (fields["warc-type"] == "revisit") == ("warc-refers-to" in fields)
    assert len(ids) == len(set(ids)) == len(ROWS)


def test_archives_are_bounded_whatever_the_input_layout(spark, tmp_path):
    import gzip

    rows = [(k, f"http://h/{k}", f"{k % 30} " + "x y" * 350_000) for k in range(36)] + [(50, "http://h/50", "z" * 20_000_000)]
    df = table_of(spark, rows).coalesce(1)
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    archive.write_arc(df, arc)
    archive.convert(spark, arc, warc)
    for path, least in ((arc, 4), (warc, 3)):
        sizes = []
        for name in os.listdir(path):
            if name.startswith("part-"):
                with gzip.open(f"{path}/{name}") as f:
                    sizes.append(len(f.read()))
        assert len(sizes) >= least and sorted(sizes)[-2] < 17 << 20 and max(sizes) < 21_000_000
    got = archive.archived_pages(df).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)
