import gzip
import io

import pytest

from tickloom.llm.archives import (
    arc_record,
    arc_records,
    arc_version_block,
    archived_pages,
    converted,
    http_response,
    read_warc,
    warc_records,
    write_arc,
    arc_to_warc,
)

LONG = "<html>" + "same " * 40 + "</html>"
PAGES = [
    (5, "http://a.example/x y", LONG),
    (2, "http://b.example/", LONG),
    (9, None, LONG),
    (1, "http://c.example/ü", "short"),
    (3, "http://d.example/", "short"),
    (4, "http://e.example/", None),
    (6, "http://f.example/", ""),
    (7, "http://g.example/", "a\r\n\r\nWARC/1.0\r\n\r\nb\n" * 20),
    (8, "http://h.example/", "x" * 300_000),
    (2, "http://b.example/", LONG),
    (None, "http://n.example/", LONG),
]


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions_are_parsed_by_their_fields(version):
    name, date = "old.arc", "19990102030405"
    body = http_response("7", b"text\n\nwith lines\n")
    records = [arc_version_block(name, version, date)]
    records.append(arc_record("http://a/", "1.2.3.4", date, "text/html", body, version, name, len(records[0]) + 1))
    found = list(arc_records(io.BytesIO(b"".join(r + b"\n" for r in records))))
    assert [o for o, _, _ in found] == [0, len(records[0]) + 1]
    assert found[1][1]["Archive-length"] == str(len(body)) and found[1][2] == body
    assert ("Result-code" in found[1][1]) == (version == 2)
    made = converted(name, found[1][0], found[1][1], found[1][2])
    assert made["kind"] == "response" and made["date"] == "1999-01-02T03:04:05Z" and made["page"] == "7"
    assert made["payload"] == b"text\n\nwith lines\n"
    assert converted(name, 0, *found[0][1:])["kind"] == "warcinfo"
    assert converted(name, 9, found[1][1], b"no http")["kind"] == "resource"


def test_broken_archives_are_refused():
    block = arc_version_block("n", 1, "20000101000000") + b"\n"
    with pytest.raises(ValueError, match="not an ARC header"):
        list(arc_records(io.BytesIO(block + b"http://a/ text/html 5\nhello\n")))
    with pytest.raises(ValueError, match="declared length"):
        list(arc_records(io.BytesIO(block + b"http://a/ 1.1.1.1 20000101000000 text/html 50\nhello\n")))
    with pytest.raises(ValueError, match="version block"):
        list(arc_records(io.BytesIO(b"filedesc://n 0.0.0.0 1 text/plain 6\n1 0 x\n")))


def test_pages_come_back(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(3)
    got = archived_pages(df).collect()
    assert len(got) == len(PAGES)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    responses = {"1", "3", "4", "6", "7", "8"}
    expected = [(i, "response", None) for i in responses]
    # Rows of the smallest id are responses, repeated ones too; others refer to it.
    expected += [("2", "response", None)] * 2 + [(i, "revisit", 2) for i in ("5", "9", "None")]
    assert kinds == sorted(expected, key=str) or sorted(kinds, key=str) == sorted(expected, key=str)
    sizes = {r.page_id: r.payload_bytes for r in got}
    assert sizes[8] == 300_000 and sizes[4] == 0 and sizes[9] == len(LONG)


def test_files_are_warc(spark, tmp_path):
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(2)
    write_arc(df, arc)
    arc_to_warc(spark, arc, warc, records_per_file=3)
    files = list((tmp_path / "warc").glob("*.gz"))
    assert len(files) > 3
    headers = [h for f in files for h, _ in warc_records(gzip.open(f))]
    assert sum(h["warc-type"] == "warcinfo" for h in headers) == 2
    ids = [h["warc-record-id"] for h in headers]
    assert len(set(ids)) == len(ids)
    for h in headers:
        if h["warc-type"] == "revisit":
            assert h["warc-refers-to"] in ids and h["warc-profile"].endswith("identical-payload-digest")
    payloads = {r.page: r.payload for r in read_warc(spark, warc).collect()}
    assert bytes(payloads["7"]).decode() == PAGES[7][2]


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert archived_pages(empty).collect() == []


def test_clashing_columns_do_not_matter(spark):
    extra = ", record string, kind int, page string, digest int, first string, content binary, payload_bytes string"
    rows = [(*row, "x", 1, "y", 2, "z", bytearray(b"w"), "v") for row in PAGES]
    wide = spark.createDataFrame(rows, "page_id bigint, url string, html string" + extra)
    narrow = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    found, expected = (sorted(map(repr, archived_pages(df).collect())) for df in (wide, narrow))
    assert found == expected
