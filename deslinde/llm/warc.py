"""Legacy archives: ARC records parsed by declared lengths, turned into WARC records, and WARC archives read back."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deslinde.llm.common import column, ready, scratch_path, texts_of

# The field names by which the version block of an ARC file describes its record lines.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:deslinde:warc")
RECORDS_PER_FILE = 2000


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _field(text: str | None) -> str:
    """A value fit for a space-parted header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in text or "") or "-"


def arc_header(version: int, name: str, date: str, ip: str = "0.0.0.0") -> bytes:
    """The version block that opens an ARC file."""
    body = f"{version} 0 deslinde\n{' '.join(ARC_FIELDS[version])}\n\n"
    head = {"URL": f"filedesc://{name}", "IP-address": ip, "Archive-date": date, "Content-type": "text/plain", "Result-code": "200"}
    return arc_line(version, head, len(body)) + body.encode("ascii") + b"\n"


def arc_line(version: int, values: dict[str, str], length: int) -> bytes:
    own = {**values, "Archive-length": str(length)}
    return (" ".join(_field(own.get(f)) for f in ARC_FIELDS[version]) + "\n").encode("utf-8")


def parse_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header values, body) of each record after the version block.

    The version block names the fields of the record lines; a body is as long as its line declares,
    whatever it holds. Blank lines between records are passed over. A file that ends within a record
    or whose line doesn't fit its version raises ValueError.
    """
    at, fields = 0, None
    while at < len(content):
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError("an ARC header line without end")
        line = content[at:end].rstrip(b"\r")
        if not line:
            at = end + 1
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        if not parts[-1].isdigit():
            raise ValueError(f"an ARC header line without length: {line[:80]!r}")
        stop = end + 1 + int(parts[-1])
        if stop > len(content):
            raise ValueError("an ARC record is cut off")
        body = content[end + 1 : stop]
        if fields is None:
            version, _, rest = body.partition(b"\n")
            fields = rest.partition(b"\n")[0].decode("ascii").split()
            if not parts[0].startswith("filedesc:") or fields != ARC_FIELDS.get(int(version.split()[0])):
                raise ValueError("not an ARC version block")
        elif len(parts) != len(fields):
            raise ValueError(f"an ARC header line of {len(parts)} fields, {len(fields)} are declared")
        else:
            yield dict(zip(fields, parts)), body
        at = stop


PAGES_AS_ARC = "archive string, content binary"


def pages_as_arc(pages: DataFrame) -> DataFrame:
    """(archive, content): ARC files of the pages of each Arrow batch, of version 1 and 2 in turn, with an HTTP response for each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(batches):
            version, date = 1 + turn % 2, "20240101000000"
            ids, urls = column(batch, "page_id").to_pylist(), column(batch, "url").to_pylist()
            raw, at = texts_of(column(batch, "html"))
            parts = [arc_header(version, f"batch-{turn}.arc", date)]
            for k, (page_id, url) in enumerate(zip(ids, urls)):
                payload = raw[at[k] : at[k + 1]].tobytes()
                named = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                body = f"HTTP/1.1 200 OK\r\n{named}Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii") + payload
                head = {"URL": url or "about:blank", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html", "Result-code": "200"}
                parts += [arc_line(version, head, len(body)), body, b"\n"]
            yield pa.RecordBatch.from_arrays([pa.array([f"batch-{turn}.arc"]), pa.array([b"".join(parts)], pa.binary())], ["archive", "content"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, PAGES_AS_ARC)


CONVERTED = "page_id long, uri string, date string, ip string, http string, payload binary, digest string, record_id string"


def convert(archives: DataFrame) -> DataFrame:
    """Parse ARC files (archive, content) into what WARC records need, with identifier, timestamp and digest made up.

    The identifier is a name-based UUID of uri, date, page and digest, so a task that runs again, or a
    file that is converted again, gives the same one. A 14-digit date becomes an ISO timestamp; shorter
    dates count from their start. Bodies that are no HTTP response are payload from the first byte.
    """
    names = [c.split()[0] for c in CONVERTED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in column(batch, "content"):
                rows = []
                for head, body in parse_arc(content.as_py() or b""):
                    http, payload = split_http(body)
                    page = http_field(http, "x-page-id")
                    digest = base32_sha1(payload)
                    name = f"{head['URL']}\n{head['Archive-date']}\n{page}\n{digest}"
                    rows.append((
                        None if page is None else int(page), head["URL"], iso_date(head["Archive-date"]), head["IP-address"],
                        http.decode("utf-8", "replace"), payload, digest, f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>",
                    ))
                    if sum(len(r[5]) for r in rows[-8:]) > 8 << 20 or len(rows) == 512:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    return archives.select("content").mapInArrow(run, CONVERTED)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names)


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """The HTTP header with its blank line, and the payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    for mark in (b"\r\n\r\n", b"\n\n"):
        if (at := body.find(mark)) >= 0:
            return body[: at + len(mark)], body[at + len(mark) :]
    return body, b""


def http_field(http: bytes, name: str) -> str | None:
    for line in http.split(b"\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.encode():
            return value.strip().decode("latin-1")
    return None


def iso_date(digits: str) -> str:
    full = (digits + "00000101000000"[len(digits) :]) if digits.isdigit() and len(digits) <= 14 else "19700101000000"
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def with_types(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Of records with equal payloads of at least ``least_bytes`` the one with the largest page_id is the response, the others revisit it.

    Rows without a page_id come before all others; rows that repeat the response's page_id and payload
    are responses too. The largest id is found by an aggregate on digests alone and joined back.
    """
    lead = records.groupBy(F.col("digest").alias("__digest")).agg(
        F.max(F.struct("page_id", "uri", "date", "record_id")).alias("__lead")
    )
    small = F.octet_length("payload") < least_bytes
    first = small | F.col("page_id").eqNullSafe(F.col("__lead.page_id"))
    return records.join(lead, F.col("digest") == F.col("__digest")).select(
        *records.columns, F.when(first, "response").otherwise("revisit").alias("record_type"),
        *(F.when(~first, F.col(f"__lead.{c}")).alias(f"refers_{c}") for c in ("record_id", "uri", "date")),
    )


def _warc_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            revisit = r["record_type"] == "revisit"
            http = r["http"].encode("utf-8")
            block = http if revisit else http + (r["payload"] or b"")
            lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Target-URI: {r['uri']}",
                     f"WARC-Date: {r['date']}", f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha1:{r['digest']}",
                     f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
            if revisit:
                lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {r['refers_record_id']}",
                          f"WARC-Refers-To-Target-URI: {r['refers_uri']}", f"WARC-Refers-To-Date: {r['refers_date']}"]
            kind = "application/http; msgtype=response" if http else "application/octet-stream"
            lines += [f"Content-Type: {kind}", f"Content-Length: {len(block)}", "", ""]
            out.append("\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n")
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write typed records as WARC files under ``path``, at most `RECORDS_PER_FILE` records each.

    Spark's text writer puts the bytes of a row and a line end; as a WARC record ends with one, the
    files are plain WARC (one gzip stream each unless ``compression`` is "none").
    """
    lines = records.mapInArrow(_warc_lines, "record binary").select(F.expr("cast(substring(record, 1, octet_length(record) - 1) as string)").alias("value"))
    lines.write.option("lineSep", "\n").option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", compression).text(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header values by small-letter name, block) of each record, by declared lengths."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if not content.startswith(b"WARC/", at) or end < 0:
            raise ValueError("not a WARC record")
        head = {}
        for line in content[at:end].split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            head[key.strip().lower().decode("ascii")] = value.strip().decode("utf-8")
        stop = end + 4 + int(head["content-length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record is cut off")
        yield head, content[end + 4 : stop]
        at = stop + 4


READ = "page_id long, record_id string, record_type string, refers_record_id string, payload_bytes long, payload_digest string, uri string, date string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files under ``path``: of responses the payload is measured and hashed anew, of revisits it is as declared."""
    names = [c.split()[0] for c in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in column(batch, "value").cast(pa.binary()):
                rows = []
                for head, block in parse_warc(value.as_py()):
                    http, payload = split_http(block)
                    page, digest = http_field(http, "x-page-id"), head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response":
                        size, own = len(payload), base32_sha1(payload)
                        if own != digest:
                            raise ValueError(f"payload of {head['warc-record-id']} doesn't have its digest")
                    else:
                        size = int(http_field(http, "content-length") or 0)
                    rows.append((
                        None if page is None else int(page), head["warc-record-id"], head["warc-type"], head.get("warc-refers-to"),
                        size, digest, head["warc-target-uri"], head["warc-date"],
                    ))
                if rows:
                    yield _batch(rows, names)

    return spark.read.text(path, wholetext=True).mapInArrow(run, READ)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) through ARC and WARC, and give a row for every record read back.

    (page_id, payload_bytes, payload_digest, record_type, refers_to): a null html is an empty payload, a
    null url becomes about:blank, a row without page_id keeps a null id; repeated rows have a record
    each; an empty table gives no row; other columns are not read. The files stay under ``path``, or in
    a fresh folder beside the checkpoints.
    """
    spark = ready(pages.sparkSession)
    path = path or scratch_path(spark, "warc")
    write_warc(with_types(convert(pages_as_arc(pages))), path)
    records = read_warc(spark, path)
    leads = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("__id")).agg(F.max("page_id").alias("__page"))
    return records.join(leads, F.col("refers_record_id") == F.col("__id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("__page").alias("refers_to")
    )


