from __future__ import annotations

import gzip
import hashlib
import io

import pytest

from comptoir.llm import archives as ar
from comptoir.session import scratch_path


def expected(rows):
    out = []
    for page, _, text in rows:
        raw = (text or "").encode()
        same = [p for p, _, t in rows if (t or "") == (text or "") and p is not None]
        again = len(raw) >= 1000 and page is not None and page < max(same)
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    long, uni = "x" * 1500, "é🙂\r\n\r\nWARC/1.1\r\n" * 80
    rows = [
        (1, "http://a/ b\nc", long), (2, "http://a/", long), (3, None, long), (None, "u", long), (4, "http://é/", uni), (9, "x", uni), (5, "", None),
        (6, "http://a/", ""), (7, "http://a/", "short"), (8, "http://a/", "short"), (-5, "n", "y" * 999), (-6, "n", "y" * 999), (2**62 + 3, "b", "z" * 1000),
        (-(2**63), "b", "z" * 1000), (11, "h", "HTTP/1.1 200 OK\r\nX-Page-Id: 99\r\n\r\nbody"), (11, "h", "\n\n"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    got = sorted((tuple(r)[:5] for r in ar.convert(df).collect()), key=str)
    assert got == expected(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "u", "q" * 2000), (1, "u", "q" * 2000), (0, "u", "q" * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in ar.convert(df).collect()) == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]
    assert ar.convert(df.limit(0)).count() == 0


def test_offsets_that_headers_declare(spark):
    """A version 2 line tells the byte at which its record begins."""
    path = scratch_path(spark, "arc")
    df = spark.createDataFrame([(i, f"http://é/{i} x", "text é\n" * i) for i in range(40)], "page_id long, url string, html string").repartition(4)
    ar.write_arc(df, path)
    told = 0
    for row in ar._files(spark, path).collect():
        for offset, fields, _ in ar.arc_records(gzip.GzipFile(fileobj=io.BytesIO(bytes(row["content"])))):
            if "Offset" in fields:
                assert int(fields["Offset"]) == offset
                told += offset > 0
    assert told >= 10


def test_both_versions_by_their_own_line_and_without():
    one = b"filedesc://a 0.0.0.0 20240101000000 text/plain 9\n1 0 x\nURL\nhttp://a/b c 1.2.3.4 20200102030405 text/html 5\nhe\nlo\n"
    two = b"http://a/ 1.2.3.4 20200102030405 text/html 200 - - 0 f 3\nabc\n"
    got = list(ar.arc_records(io.BytesIO(one)))
    assert [(f["URL"], c) for _, f, c in got[1:]] == [("http://a/b c", b"he\nlo")]
    named = b"filedesc://a 0.0.0.0 20240101000000 text/plain 200 - - 0 f 6\n2 0 x\n\n" + two
    got = list(ar.arc_records(io.BytesIO(named)))
    assert [(f["URL"], f.get("Result-code"), c) for _, f, c in got[1:]] == [("http://a/", "200", b"abc")]


@pytest.mark.parametrize("bad", [b"http://a/ x\n", b"http://a/ 1 2 t 99\nshort"])
def test_broken_archives_are_refused(bad):
    with pytest.raises(ValueError):
        list(ar.arc_records(io.BytesIO(bad)))


@pytest.mark.parametrize("page", [0, 1, -1, 2**63 - 1, -(2**63), 123456789, None])
def test_identifiers_hold_the_page(page):
    assert ar.page_of(ar.record_id("f", 7, page)) == page
    assert ar.record_id("f", 7, page) != ar.record_id("f", 8, page)
