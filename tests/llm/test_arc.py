"""ARC archives to WARC and back."""

import base64
import gzip
import hashlib
import io

import pytest

from starmill.llm.arc_to_warc import (
    arc_head, arc_line, convert, open_archive, op1_arc_to_warc, read_arc, warc_date, warc_records, write_arc,
)

PAGE = "page_id long, url string, html string"


def expected(rows):
    """By brute force: the record with the largest id of each payload holds it."""
    largest = {}
    for i, _, html in rows:
        largest.setdefault(html or "", []).append(-1 if i is None else i)
    out = []
    for payload, ids in largest.items():
        data = payload.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        holder, *others = sorted(ids, reverse=True)
        out.append((holder, len(data), digest, "response", -1))
        out += [(i, len(data), digest, "revisit", holder) for i in others]
    return sorted(out)


def found(df):
    return sorted(
        (-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
         -1 if r.refers_to is None else r.refers_to) for r in df.collect()
    )


def test_odd_pages(spark, tables):
    rows = [
        (1, "http://a b\n", "x"), (2, None, None), (3, "http://u", ""), (None, "http://u", "x"),
        (9, "http://u", "x"), (9, "http://u", "x"), (4, "http://é", "é\r\n\r\nWARC/1.1\r\n\r\n"),
        (5, "http://v", "line\n" * 50_000), (6, "", "HTTP/1.1 200 OK\r\n\r\n"),
    ]
    assert found(op1_arc_to_warc(spark, tables(pages=(rows, PAGE)))) == expected(rows)


def test_no_pages(spark, tables):
    assert op1_arc_to_warc(spark, tables(pages=([], PAGE))).collect() == []


def test_whole_table(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert found(op1_arc_to_warc(spark, sf_dir)) == expected(rows)


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions_and_compression(version):
    blocks = [b"HTTP/1.0 200 OK\n\nbody", b"", b"plain \n\n text"]
    data = arc_head(version, "a.arc", "19970101")
    for i, block in enumerate(blocks):
        data += b"\n" + arc_line(version, f"http://x/{i} y", "1.2.3.4", "19961231235959", "text/html", block) + block
    for archive in (data, gzip.compress(data), gzip.compress(data[:40]) + gzip.compress(data[40:])):
        first, *records = read_arc(open_archive(archive))
        assert first.version == version and first.url == "filedesc://a.arc"
        assert [r.block for r in records] == blocks
        assert [r.url for r in records] == [f"http://x/{i} y" for i in range(3)]
        assert not any(r.truncated for r in records)
    *_, last = read_arc(io.BytesIO(data[:-3]))
    assert last.truncated and last.block == blocks[-1][:-3]


def test_wrong_header_lines():
    with pytest.raises(ValueError):
        list(read_arc(io.BytesIO(b"nothing like it\n")))
    with pytest.raises(ValueError):  # the fields of version 1, the number of version 2
        list(read_arc(io.BytesIO(arc_line(1, "filedesc://a", "0.0.0.0", "19970101", "text/plain", b"2 0 x\n") + b"2 0 x\n")))


def test_dates():
    assert warc_date("19970203") == "1997-02-03T00:00:00Z"
    assert warc_date("199702030405") == "1997-02-03T04:05:00Z"
    assert warc_date("19970203040506") == "1997-02-03T04:05:06Z"


def test_small_payloads_are_never_revisits(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, "http://c", "longer same"), (4, "http://d", "longer same")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGE + ", record string")
    write_arc(pages, f"file:{tmp_path}/arc", versions=(2,))
    convert(spark, f"file:{tmp_path}/arc", f"file:{tmp_path}/warc", min_bytes=5)
    kinds = {r.row: r.record_type for r in warc_records(spark, f"file:{tmp_path}/warc").collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}
