import gzip
import hashlib
from pathlib import Path

import pytest

from plexlake.llm import skew, warc
from plexlake.plans import sizing

SCHEMA = "page_id long, url string, html string, record_type string, digest string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def _plain(rows):
    """Expected (page_id, bytes, digest, type, refers_to) as a sorted list."""
    groups, out = {}, []
    for page, _, html in rows:
        data = (html or "").encode()
        groups.setdefault(data, []).append(page)
    for data, pages in groups.items():
        pages = sorted(pages, key=lambda p: (p is None, p or 0))
        for n, page in enumerate(pages):
            again = n > 0 and len(data) >= 100
            out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", pages[0] if again else None))
    return sorted(out, key=str)


def _got(spark, rows, parts=3):
    path = warc.write_pages(_frame(spark, rows).repartition(parts))
    got = warc.page_digests(warc.captures(warc.read_records(spark, path))).collect()
    return sorted(map(tuple, got), key=str), path


ROWS = [
    (5, "http://a/5", "x" * 100), (3, "http://a/3", "x" * 100), (9, None, "x" * 100), (4, "http://a/4", "x" * 99), (1, "u", "x" * 99),
    (7, "http://a/\r\nWARC-Type: request", None), (8, "u", ""), (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "long " * 400_000),
    (13, "u", "long " * 400_000), (14, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (15, "u", "\nWARC/\nWARC/" * 30), (16, "u", "\nWARC/\nWARC/" * 30), (17, "u", "\nWARC/"), (18, "u", "\x00\r\n\t" * 60),
    (None, "u", "n" * 200), (20, "u", "n" * 200), (None, "u", "m" * 200), (None, "u", "m" * 200),
    (21, "u", "same row" * 20), (21, "u", "same row" * 20), (21, "u", "same row" * 20),
]


@pytest.mark.parametrize("small", [True, False])
def test_round_trip(spark, monkeypatch, small):
    if not small:  # no broadcast by size, and heavy keys split off
        monkeypatch.setattr(skew, "checked_broadcast", lambda table: table)
        monkeypatch.setattr(skew, "HEAVY_ROWS", 2)
    got, _ = _got(spark, ROWS)
    assert got == _plain(ROWS)


def test_no_pages(spark):
    assert _got(spark, [])[0] == []


def test_files_are_archives(spark):
    _, path = _got(spark, ROWS, 1)
    data = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path.replace("file:", "")).glob("*.gz"))
    at, types, ids = 0, [], []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        at = end + 4 + int(fields["Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
        types.append(fields["WARC-Type"])
        ids.append(fields["WARC-Record-ID"])
    assert len(set(ids)) == len(ids) == 3 * len(ROWS)
    assert types.count("request") == types.count("metadata") == len(ROWS)


def test_captures_are_nested(spark):
    path = warc.write_pages(_frame(spark, ROWS))
    found = warc.captures(warc.read_records(spark, path, with_payload=True)).collect()
    assert len(found) == len(ROWS) and all(r.n_request == r.n_metadata == 1 for r in found)
    by_page = {r.metadata.fields["page_id"]: r for r in found if "page_id" in r.metadata.fields}
    assert bytes(by_page["14"].payload).decode() == ROWS[11][2] and by_page["14"].http_status == 200
    assert by_page["5"].record_type == "revisit" and by_page["5"].refers_to == by_page["3"].record_id
    assert by_page["5"].digest == "sha256:" + by_page["3"].payload_sha256 and not by_page["5"].payload
    assert by_page["3"].request.target_uri == "http://a/3"
    assert by_page["7"].target_uri == "http://a/%0D%0AWARC-Type: request"


def _write(path, *records, each=False):
    blocks = []
    for fields, body in records:
        head = "".join(f"{k}: {v}\r\n" for k, v in fields)
        blocks.append(f"WARC/1.0\r\n{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")
    path.write_bytes(b"".join(gzip.compress(b) for b in blocks) if each else b"".join(blocks))


def test_foreign_archive(spark, tmp_path):
    http = [("Content-Type", "application/http; msgtype=response")]
    _write(
        tmp_path / "a.warc.gz",
        ([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<i>")], b"software: x\r\n"),
        ([("WARC-Type", "response"), ("WARC-Record-ID", "<r1>"), ("WARC-Concurrent-To", "<q1>"), *http], b"HTTP/1.1 404 No\r\nA: b\r\n\r\n\xff\x00body"),
        ([("WARC-Type", "request"), ("WARC-Record-ID", "<q1>")], b"GET"),
        ([("WARC-Type", "metadata"), ("WARC-Record-ID", "<m2>"), ("WARC-Concurrent-To", "<r1>")], b"x: 2"),
        ([("WARC-Type", "metadata"), ("WARC-Record-ID", "<m1>"), ("WARC-Concurrent-To", "<other>"), ("WARC-Concurrent-To", "<r1>")], b"x: 1"),
        ([("WARC-Type", "metadata"), ("WARC-Record-ID", "<m9>"), ("WARC-Concurrent-To", "<gone>")], b""),
        ([("WARC-Type", "response"), ("WARC-Record-ID", "<r2>")], b""),
        each=True,
    )
    (tmp_path / "cut.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <c>\r\nContent-Length: 50\r\n\r\nshort")
    records = warc.read_records(spark, str(tmp_path), with_payload=True).persist()
    found = {r.record_id: r for r in warc.captures(records).collect()}
    assert set(found) == {"<r1>", "<r2>", "<c>"}
    assert bytes(found["<r1>"].payload) == b"\xff\x00body" and found["<r1>"].http_status == 404 and found["<r1>"].fields["a"] == "b"
    assert found["<r1>"].request.record_id == "<q1>" and found["<r1>"].metadata.record_id == "<m1>" and found["<r1>"].n_metadata == 2
    assert found["<r2>"].request is None and found["<r2>"].n_request == 0
    assert found["<c>"].truncated and not found["<r1>"].truncated
    assert [r.record_id for r in warc.orphans(records).collect()] == ["<m9>"]
    records.unpersist()


def test_bounds_of_broadcasts(spark):
    assert skew.HEAVY_KEYS <= sizing.BROADCAST_ROWS
