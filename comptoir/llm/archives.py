"""Legacy ARC archives converted to WARC, written and read as files in a shared folder.

An ARC file begins with a record that names its version; a version 1 header line has five fields, a version
2 line ten. Records are taken by their declared lengths. For each, a WARC identifier, timestamp, type and
digests are made up; of equal payloads one is kept as a response and the others become revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map
from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage, scratch_path

# The field lists that follow the version line of an ARC file.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARCHIVED = "20240101000000"
LEAST_SHARED = 1000
"""Payload bytes from which equal payloads are stored once."""
PAGE_HEADER = "X-Page-Id"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _arc_head(version: int, url: str, ip: str, mime: str, length: int, code: str = "200", offset: int = 0, name: str = "-") -> str:
    if version == 1:
        return f"{url} {ip} {ARCHIVED} {mime} {length}"
    return f"{url} {ip} {ARCHIVED} {mime} {code} - - {offset} {name} {length}"


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html") -> None:
    """One gzipped ARC file per partition, of version 1 or 2 in turn, a record per row with its HTTP header.

    A null body is empty; a null address becomes ``unknown:``; blanks and control characters in addresses are
    percent-encoded. The row's key goes into the HTTP header, and is left out there if null.
    """
    def run(batches):
        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part:05d}.arc"
        about = f"{version} 0 comptoir\n{FIELDS[version]}\n"
        first = f"{_arc_head(version, f'filedesc://{name}', '0.0.0.0', 'text/plain', len(about), name=name)}\n{about}"
        place = len(first) + 1  # each record is followed by a line end
        begun = False
        for batch in batches:
            out = [] if begun else [first]
            begun = True
            for page, address, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                address = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", address) if address else "unknown:"
                size = len(text.encode())
                named = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{named}Content-Length: {size}\r\n\r\n"
                line = _arc_head(version, address, "0.0.0.0", "text/html", len(head) + size, offset=place, name=name)
                out.append(f"{line}\n{head}{text}")
                place += len(line.encode()) + 1 + len(head) + size + 1
            yield pa.record_batch([pa.array(out, pa.string())], ["value"])

    source = pages.select(F.col(key).cast("long"), F.col(url), F.coalesce(F.col(body), F.lit("")))
    source.transform(arrow_map, run, "value string").write.options(**_OPTIONS).option("lineSep", "\n").text(path)


def arc_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of each record. The file's own first record names the version; without
    one, the number of fields in a line does."""
    version, place = None, 0
    while True:
        line = stream.readline()
        if not line:
            return
        begin, place = place, place + len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            continue
        named = version or (2 if text.count(" ") >= 9 and text.startswith("filedesc://") else 1)
        names = FIELDS[named].split()
        parts = text.rsplit(" ", len(names) - 1)
        if len(parts) != len(names) or not parts[-1].isdigit():
            raise ValueError(f"no ARC header line of version {named} at byte {begin}: {text[:200]!r}")
        fields = dict(zip(names, parts))
        content = stream.read(int(fields["Archive-length"]))
        if len(content) != int(fields["Archive-length"]):
            raise ValueError(f"ARC record at byte {begin} is cut short")
        place += len(content)
        if fields["URL"].startswith("filedesc://"):
            version = int(content.split(None, 1)[0])
        yield begin, fields, content


def record_id(file: str, offset: int, page: int | None) -> str:
    """A UUID of the free version 8: 47 bits tell the place in the archive, one whether there is a page id, 64
    are the page id."""
    mark = int.from_bytes(hashlib.sha1(f"{file}:{offset}".encode()).digest()[:6], "big") & ~1 | (page is not None)
    low = (page or 0) & (1 << 64) - 1
    return str(uuid.UUID(int=mark << 80 | 8 << 76 | (low >> 62) << 64 | 2 << 62 | low & (1 << 62) - 1))


def page_of(identifier: str) -> int | None:
    n = uuid.UUID(identifier).int
    if not n >> 80 & 1:
        return None
    low = (n >> 64 & 3) << 62 | n & (1 << 62) - 1
    return low - (1 << 64) if low >> 63 else low


def _split_http(content: bytes) -> tuple[bytes, bytes]:
    head, gap, payload = content.partition(b"\r\n\r\n")
    return (head + gap, payload) if gap and head.startswith(b"HTTP/") else (b"", content)


def _field(head: bytes, name: str) -> str | None:
    m = re.search(rb"^" + re.escape(name).encode() + rb":[ \t]*([^\r\n]*)", head, re.MULTILINE | re.IGNORECASE)
    return m[1].decode("utf-8", "replace").strip() if m else None


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 100 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if weight > size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def captures(file: str, content: bytes) -> Iterator[tuple]:
    """(offset, record id, page id, header fields, HTTP header, payload) of each capture in a gzipped ARC file."""
    for offset, fields, block in arc_records(gzip.GzipFile(fileobj=io.BytesIO(content))):
        if fields["URL"].startswith("filedesc://"):
            continue
        head, payload = _split_http(block)
        page = _field(head, PAGE_HEADER)
        page = int(page) if page and re.fullmatch(r"-?\d{1,19}", page) else None
        yield offset, record_id(file.rpartition("/")[2], offset, page), page, fields, head, payload


def index_arc(spark: SparkSession, path: str) -> DataFrame:
    """What tells equal payloads in the ARC files under ``path``: ``file, offset, record_id, page_id, payload_bytes,
    digest`` of each capture. Payloads stay where they are."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.string())])

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                name = file.as_py()
                yield from _batched((
                    (name, offset, own, page, len(payload), hashlib.sha1(payload).hexdigest())
                    for offset, own, page, _, _, payload in captures(name, content.as_py())
                ), schema)

    return _files(spark, path).transform(arrow_map, run, "file string, offset long, record_id string, page_id long, payload_bytes long, digest string")


def revisits(index: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``file, offset, kept_id`` of captures whose payload of ``least`` bytes or more is that of a capture with a larger
    page id, and the record of that."""
    long = index.filter((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    shared = long.groupBy("digest", "payload_bytes").agg(F.max(F.struct("page_id", "record_id")).alias("kept"), F.count("*").alias("n")).filter("n > 1")
    shared = shared.select("digest", "payload_bytes", F.col("kept.page_id").alias("kept_page"), F.col("kept.record_id").alias("kept_id"))
    return splittable_join(long, shared, ["digest", "payload_bytes"]).filter("page_id < kept_page").select("file", "offset", "kept_id")


def warc_record(own: str, fields: dict[str, str], head: bytes, payload: bytes, kept: str | None) -> bytes:
    """A response, or a revisit of the record ``kept``, which keeps the HTTP header and leaves out the payload."""
    block, d = head if kept else head + payload, fields["Archive-date"]
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if kept else 'response'}", f"WARC-Record-ID: <urn:uuid:{own}>",
        f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", f"WARC-Target-URI: {fields['URL']}", f"WARC-IP-Address: {fields['IP-address']}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        *([f"WARC-Refers-To: <urn:uuid:{kept}>", f"WARC-Profile: {_PROFILE}"] if kept else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    return "\r\n".join(lines).encode() + block


def write_warc(spark: SparkSession, arc: str, path: str, least: int = LEAST_SHARED) -> None:
    """The ARC files under ``arc`` as WARC files, a record per capture.

    Equal payloads are told by an index of digests; what each file needs to know of it, the offsets of its revisits, is
    joined to the file, so payloads themselves are never shuffled outside their compressed archive.
    """
    by_file = revisits(cut_lineage(index_arc(spark, arc)), least).groupBy("file").agg(F.collect_list(F.struct("offset", "kept_id")).alias("again"))
    files = splittable_join(_files(spark, arc).withColumnRenamed("path", "file"), by_file, "file", "left").select("file", "content", "again")
    schema = pa.schema([("value", pa.binary())])

    def run(batches):
        for batch in batches:
            for file, content, again in zip(batch.column(0), batch.column(1), batch.column(2)):
                kept = {x["offset"]: x["kept_id"] for x in again.as_py() or ()}
                yield from _batched(((warc_record(own, fields, head, payload, kept.get(offset)),) for offset, own, _, fields, head, payload in captures(file.as_py(), content.as_py())), schema)

    records = files.transform(arrow_map, run, "value binary").select(F.col("value").cast("string").alias("value"))  # the bytes as they are
    records.write.options(**_OPTIONS).option("lineSep", "\r\n\r\n").text(path)


def warc_records(stream: io.BufferedIOBase) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record, by declared lengths."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:100]!r}")
        head = [line]
        while (line := stream.readline()).strip():
            head.append(line)
        header = b"".join(head)
        size = int(_field(header, "Content-Length") or 0)
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut short")
        yield header, block


def _hex(digest: str) -> str:
    value = digest.partition(":")[2]
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` and ``uri`` of each record, from the files."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()),
    ])

    def records(content: bytes):
        for header, block in warc_records(gzip.GzipFile(fileobj=io.BytesIO(content))):
            kind = _field(header, "WARC-Type")
            own = _field(header, "WARC-Record-ID").strip("<>").rpartition(":")[2]
            head, payload = _split_http(block)
            uri = _field(header, "WARC-Target-URI")
            if kind == "revisit":
                refers = _field(header, "WARC-Refers-To").strip("<>").rpartition(":")[2]
                size = _field(head, "Content-Length")
                yield page_of(own), int(size) if size else None, _hex(_field(header, "WARC-Payload-Digest")), kind, page_of(refers), uri
            else:
                digest = hashlib.sha1(payload).hexdigest()
                if digest != _hex(_field(header, "WARC-Payload-Digest")):
                    raise ValueError(f"payload digest of {own} does not hold")
                yield page_of(own), len(payload), digest, kind, None, uri

    def run(batches):
        for batch in batches:
            for content in batch.column(1):
                yield from _batched(records(content.as_py()), schema)

    return _files(spark, path).transform(arrow_map, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string")


def convert(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Pages written as ARC files, converted to WARC files and read back, as ``read_warc`` gives them.

    Both folders lie in the shared one. A null body is an empty payload; pages without an id are always
    responses and nothing refers to them; of rows that repeat the largest id of equal payloads each is a
    response. An empty table gives no rows. Only page_id, url and html are read.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    write_warc(spark, arc, warc, least)
    return read_warc(spark, warc)
