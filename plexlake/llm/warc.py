"""Web archives (WARC 1.1): written by Spark's text writer, read as records, assembled into captures.

A page becomes three records that stand together: the ``response`` with HTTP header and payload, or a
``revisit`` that refers to the response with the same payload, the ``request``, and a ``metadata`` record
with the page's id. Request and metadata name the first one in ``WARC-Concurrent-To``.

Reading splits files at line ends followed by ``WARC/``. A payload may hold those bytes too, so pieces are
put together again until a record has its Content-Length; a task sees the pieces of a file in order. The
files written here are compressed as a whole and read by one task each, so this is exact; in
an uncompressed file that is split between tasks, a record cut at the very border is marked ``truncated``.
Files of one compressed member a record read alike. Assembly then joins requests and metadata to
responses and revisits through the identifiers, in whichever of both directions they are stated, and makes one
nested row of each capture. Revisits find their response by its record id.

Copies of one payload may be a third of all pages: they are counted and their first found map-side,
and joins with one row for many go through :func:`plexlake.llm.skew.attach`. No payload is shuffled
while the table of repeated payloads fits a broadcast.

Defined results: a NULL payload is empty; payloads below 100 bytes are never revisits; a NULL id comes
after all others when the first of a group is sought, and stays NULL; of rows that repeat id and payload one is the
response; CR and LF in a URL are percent-encoded, a NULL URL has no header; several requests or metadata
records of a capture: the one with the smallest record id, and their number; no pages, no records.
Columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plexlake.llm.skew import attach
from plexlake.llm.stage import keep
from plexlake.plans.session import scratch_path
from plexlake.plans.sizing import spread

REVISIT_BYTES = 100
# Fixed values of the format.
_BREAK = b"\nWARC/"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ANCHORS = ("response", "revisit", "resource")
RECORDS = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "digest string, http_status int, fields map<string,string>, payload_bytes long, payload_sha256 string, payload binary, truncated boolean"
)



# --- writing ---------------------------------------------------------------------------


def _record_id(*parts: Column) -> Column:
    """A URN from a hash of ``parts``."""
    h = F.sha2(F.concat_ws(":", *parts), 256)
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str | Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record; the line separator of the text writer is its last byte. NULL fields are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit("WARC-Type: "), kind), *(F.concat(F.lit(f"{name}: "), value) for name, value in fields)]
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit("\r\n\r\n"), block, F.lit("\r\n\r"))


def _firsts(staged: DataFrame) -> DataFrame:
    """(digest, first, first_id) of payloads that several rows share: the row that is the response, and its page."""
    shared = staged.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("least")
    )
    return shared.where("n > 1").select("digest", F.col("least.row").alias("first"))


def write_pages(pages: DataFrame, path: str | None = None, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write ``pages`` (page_id, url, html) as archives; their folder, a fresh one of the shared storage by default.

    Pages are staged once with their digest and a row number, which stays the same when a lost task is run again.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    texts = spread(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")))
    staged = keep(
        texts.select(
            "*", F.octet_length("html").cast("long").alias("bytes"), F.sha2(F.col("html").cast("binary"), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pages",
    )
    firsts = keep(_firsts(staged), "firsts")
    rows = attach(staged, firsts, "digest")
    again = F.col("first").isNotNull() & (F.col("first") != F.col("row"))
    own = F.when(F.col("first") == F.col("row"), _record_id(F.lit("payload"), F.col("digest"))).otherwise(_record_id(F.lit("row"), F.col("row")))
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = rows.select("*", again.alias("again"), own.alias("own"), uri.alias("uri"))
    where = [("WARC-Target-URI", F.col("uri")), ("WARC-Date", F.lit(date))]
    header = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")
    )
    payload = F.concat(F.lit("sha256:"), F.col("digest"))
    shown = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        [("WARC-Record-ID", F.col("own")), *where, ("Content-Type", F.lit("application/http; msgtype=response")), ("WARC-Payload-Digest", payload),
         ("WARC-Refers-To", F.when(F.col("again"), _record_id(F.lit("payload"), F.col("digest")))), ("WARC-Profile", F.when(F.col("again"), _PROFILE))],
        F.when(F.col("again"), header).otherwise(F.concat(header, "html")),
    )
    beside = [("WARC-Concurrent-To", F.col("own")), *where]
    asked = _record(
        "request",
        [("WARC-Record-ID", _record_id(F.lit("request"), F.col("row"))), *beside, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce("uri", F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    about = _record(
        "metadata",
        [("WARC-Record-ID", _record_id(F.lit("metadata"), F.col("row"))), *beside, ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
    )
    path = path or scratch_path(spark, "warc")
    rows.select(F.concat_ws("\n", shown, asked, about).alias("value")).write.option("compression", "gzip").text(path)
    return path


# --- reading ---------------------------------------------------------------------------


def _head(data: bytes) -> tuple[dict[str, list[str]], int]:
    """Named fields (lower case) of a header block, and where the block behind it starts."""
    end = data.find(b"\r\n\r\n")
    head, start = (data, len(data)) if end < 0 else (data[:end], end + 4)
    fields: dict[str, list[str]] = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields.setdefault(name.decode("utf-8", "replace").strip().lower(), []).append(value.decode("utf-8", "replace").strip())
    return fields, start


def _length(fields: dict[str, list[str]]) -> int:
    try:
        return max(0, int(fields["content-length"][0]))
    except (KeyError, ValueError):
        return 0


def _parse(fields: dict[str, list[str]], block: bytes, truncated: bool, with_payload: bool) -> tuple:
    one = lambda name: fields.get(name, [None])[0]
    status, named, payload = None, {}, block
    kind = (one("content-type") or "").partition(";")[0].strip()
    if kind == "application/http":
        line = block.split(b"\r\n", 1)[0].split(b" ")
        status = int(line[1]) if line[0].startswith(b"HTTP/") and len(line) > 1 and line[1].isdigit() else None
        http, start = _head(block)
        named, payload = {k: v[0] for k, v in http.items()}, block[start:]
    elif kind == "application/warc-fields":
        found, _ = _head(b"\r\n" + block)
        named = {k: v[0] for k, v in found.items() if k}
    return (
        one("warc-record-id"), one("warc-type"), fields.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), one("warc-date"),
        one("warc-payload-digest"), status, list(named.items()), len(payload), hashlib.sha256(payload).hexdigest(),
        payload if with_payload else None, truncated,
    )


def _records(with_payload: bool):
    types = [
        pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(),
        pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary(), pa.bool_(),
    ]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        at, parts, fields, missing = None, [], {}, 0  # the record that pieces are added to

        def finish() -> None:
            nonlocal size, parts
            if parts:
                data = b"".join(parts)
                start = _head(data)[1]
                block = data[start : start + _length(fields)]
                rows.append(_parse(fields, block, len(block) < _length(fields), with_payload))
                size += len(block)
            parts = []

        def batch_of() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for file, split, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if parts and (file, split) == at and missing > 0:
                    parts += [_BREAK, piece]
                    missing -= len(_BREAK) + len(piece)
                    continue
                finish()
                if not piece.strip():
                    continue
                at, parts = (file, split), [piece]
                fields, start = _head(piece)
                missing = _length(fields) + start - len(piece)
                if missing <= 0:
                    finish()
                if size > 16 << 20 or len(rows) >= 5_000:
                    yield batch_of()
                    rows, size = [], 0
        finish()
        if rows:
            yield batch_of()

    return read


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record below ``path``; payloads are measured and hashed, and returned where asked for."""
    pieces = spark.read.option("lineSep", _BREAK.decode()).text(path)
    placed = pieces.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary"))
    return placed.mapInArrow(_records(with_payload), RECORDS)


# --- transactions ----------------------------------------------------------------------


def _links(records: DataFrame) -> DataFrame:
    """(anchor, companion): record ids that belong together, whichever of them names the other."""
    stated = records.select("record_id", "record_type", F.explode("concurrent_to").alias("other"))
    first = F.col("record_type").isin(*_ANCHORS)
    return stated.select(
        F.when(first, F.col("record_id")).otherwise(F.col("other")).alias("anchor"),
        F.when(first, F.col("other")).otherwise(F.col("record_id")).alias("companion"),
    ).distinct()


def captures(records: DataFrame) -> DataFrame:
    """One row per response, revisit or resource with its ``request`` and ``metadata`` (structs, NULL if there is none).

    Records are written once to shared storage: they are read from the archives a single time, and the
    joins below see a table. Companions are combined map-side into one per kind and capture, so a capture
    with very many of them is no large group.
    """
    kept = keep(records, "records")
    others = kept.where(~F.col("record_type").isin(*_ANCHORS))
    told = others.select("record_id", "record_type", "concurrent_to", "target_uri", "fields")
    links = _links(kept.select("record_id", "record_type", "concurrent_to"))
    found = told.join(links, F.col("record_id") == F.col("companion"))

    def one(kind: str) -> Column:
        row = F.struct("record_id", "target_uri", "fields")
        return F.min_by(F.when(F.col("record_type") == kind, row), F.when(F.col("record_type") == kind, F.col("record_id"))).alias(kind)

    def number(kind: str) -> Column:
        return F.count_if(F.col("record_type") == kind).alias(f"n_{kind}")

    beside = found.groupBy("anchor").agg(one("request"), one("metadata"), number("request"), number("metadata"))
    shown = kept.where(F.col("record_type").isin(*_ANCHORS))
    joined = shown.join(beside, F.col("record_id") == F.col("anchor"), "left").drop("anchor", "concurrent_to")
    return joined.fillna(0, ["n_request", "n_metadata"])


def orphans(records: DataFrame) -> DataFrame:
    """Requests and metadata that belong to no capture of ``records``."""
    shown = records.where(F.col("record_type").isin(*_ANCHORS)).select(F.col("record_id").alias("anchor"))
    linked = _links(records).join(shown, "anchor", "left_semi").select(F.col("companion").alias("record_id"))
    return records.where(F.col("record_type").isin("request", "metadata")).join(linked, "record_id", "left_anti")


def page_digests(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of captures, revisits resolved.

    A revisit has the size and digest of the response it refers to, as read back from the archives.
    """
    page = F.try_element_at(F.col("metadata.fields"), F.lit("page_id")).cast("long")
    rows = keep(found.select("record_id", "record_type", "refers_to", page.alias("page_id"), "payload_bytes", "payload_sha256"), "captures")
    targets = rows.where(F.col("record_type") == "response").join(
        rows.where(F.col("refers_to").isNotNull()).select(F.col("refers_to").alias("record_id")).distinct(), "record_id", "left_semi"
    )
    targets = keep(
        targets.select(
            F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"), F.col("payload_bytes").alias("target_bytes"),
            F.col("payload_sha256").alias("target_sha256"),
        ),
        "targets",
    )
    revisit = F.col("record_type") == "revisit"
    return attach(rows, targets, "refers_to").select(
        "page_id", F.when(revisit, F.col("target_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("target_sha256")).otherwise(F.col("payload_sha256")).alias("payload_digest"),
        "record_type", F.when(revisit, F.col("target")).alias("refers_to"),
    )
