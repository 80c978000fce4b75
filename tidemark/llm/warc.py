"""Legacy ARC archives to WARC: parse by version and declared length, synthesise what WARC asks for.

An ARC file starts with a version block whose first lines say which columns the record header lines
have: version 1 ``URL IP-address Archive-date Content-type Archive-length``, version 2 the same with
``Result-code Checksum Location Offset Filename`` before the length. A record is its header line,
exactly Archive-length bytes, and a newline.

For each record the converter makes a record id (a name-based UUID of archive and offset, so reruns
agree), an ISO date, a type, and block and payload digests. Of records with equal payloads of at
least REVISIT_BYTES bytes, the one with the smallest key is a response and the others revisit it.

Defined cases: a null URL is written as ``-`` and comes back null; blanks in a URL become %20; a null
payload is empty; a null key never is the one revisited unless all are null (then each is a
response); a short or damaged record raises; an empty table makes no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import mark_hot, open_shared, scratch_path, slices, split_join, stored

# Fixed values of the ARC and WARC formats.
V1_COLUMNS = b"URL IP-address Archive-date Content-type Archive-length"
V2_COLUMNS = b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1\r\n"
#: Payloads below this many bytes are always written in full.
REVISIT_BYTES = 100
#: Header of the message that carries the row's key through the archives.
KEY_HEADER = "X-Record-Key"

RECORDS = ("key long, record_id string, url string, ip string, date string, mime string, kind string, "
           "http binary, payload binary, payload_bytes long, payload_digest string")
MANIFEST = "path string, records long"
READ = ("key long, record_id string, url string, date string, record_type string, payload binary, payload_bytes long, "
        "payload_digest string, refers_to long, refers_to_id string")


# ---- ARC ----

def arc_header(name: str, version: int, date: str) -> bytes:
    """The version block that opens an archive."""
    body = (b"%d 0 Legacy\n" % version) + (V1_COLUMNS if version == 1 else V2_COLUMNS) + b"\n"
    extra = "" if version == 1 else f" 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, ip: str, date: str, mime: str, body: bytes, name: str, offset: int) -> bytes:
    extra = "" if version == 1 else f" 200 {zlib.crc32(body):08x} - {offset} {name}"
    return f"{url} {ip} {date} {mime}{extra} {len(body)}\n".encode() + body + b"\n"


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of each record after the version block."""
    stream = io.BytesIO(data)
    columns: list[str] = []
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        if line == b"\n":
            continue
        values = line.rstrip(b"\r\n").decode("utf-8", "surrogateescape").split(" ")
        if not line.endswith(b"\n") or not values[-1].isdigit():
            raise ValueError(f"no ARC header line at byte {offset}")
        size = int(values[-1])
        content = stream.read(size)
        if len(content) != size:
            raise ValueError(f"the record at byte {offset} declares {size} bytes and has {len(content)}")
        if values[0].startswith("filedesc:"):
            lines = content.split(b"\n")
            version = lines[0].split(b" ")[0]
            if version not in (b"1", b"2") or len(lines) < 2:
                raise ValueError(f"ARC version {version!r} at byte {offset}")
            columns = lines[1].decode().split(" ")
            continue
        if not columns:
            raise ValueError("the archive has no version block")
        if len(values) != len(columns):
            raise ValueError(f"{len(values)} fields for {len(columns)} columns at byte {offset}")
        yield offset, dict(zip(columns, values, strict=True)), content


def to_arc(pages: DataFrame, key: str, url: str, html: str, archive_bytes: int = 4 << 20) -> DataFrame:
    """Rows as ARC archives (name, content) of about archive_bytes, of version 1 and 2 in turn."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, rows in enumerate(slices(batches, "html", archive_bytes)):
            version, name = 1 + n % 2, f"legacy-{part:06d}-{n:06d}.arc"
            out = bytearray(arc_header(name, version, "20080101000000"))
            for k, u, h in zip(*(rows[c].to_pylist() for c in ("key", "url", "html")), strict=True):
                body = (h or "").encode()
                date = datetime.fromtimestamp(1_200_000_000 + (k or 0) % 100_000_000, UTC).strftime("%Y%m%d%H%M%S")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
                head += f"{KEY_HEADER}: {k}\r\n\r\n" if k is not None else "\r\n"
                link = "-" if u is None else "".join(f"%{ord(c):02X}" if c in " \t\r\n" else c for c in u) or "%00"
                out += arc_record(version, link, "192.0.2.1", date, "text/html", head.encode() + body, name, len(out))
            yield pa.RecordBatch.from_pydict({"name": pa.array([name]), "content": pa.array([bytes(out)], pa.binary())})

    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(write, "name string, content binary")


# ---- conversion ----

def _http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, header bytes and payload of a network message; without a header all is payload."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return {}, block, b""
    fields = dict(x.split(": ", 1) for x in block[:end].decode("latin-1").split("\r\n")[1:] if ": " in x)
    return fields, block[:end + 4], block[end + 4:]


def convert(archives: DataFrame) -> DataFrame:
    """ARC archives (name, content) as the records WARC needs (see RECORDS)."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = []
                for offset, fields, block in parse_arc(content):
                    head, http, payload = _http(block)
                    when = datetime.strptime(fields["Archive-date"][:14], "%Y%m%d%H%M%S").replace(tzinfo=UTC)
                    url = fields["URL"]
                    rows.append({
                        "key": int(head[KEY_HEADER]) if KEY_HEADER in head else None,
                        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{offset}')}",
                        "url": None if url == "-" else url, "ip": fields["IP-address"], "date": when.strftime("%Y-%m-%dT%H:%M:%SZ"),
                        "mime": fields["Content-type"], "kind": "response" if http else "resource", "http": http, "payload": payload,
                        "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest()})
                for lo in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_pylist(rows[lo:lo + 256], schema=_RECORDS)

    return archives.mapInArrow(records, RECORDS)


_RECORDS = pa.schema([("key", pa.int64()), *((c, pa.string()) for c in ("record_id", "url", "ip", "date", "mime", "kind")), ("http", pa.binary()),
                      ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def revisits(records: DataFrame) -> DataFrame:
    """records with refers_to and refers_to_id: the record to revisit, null where the record is a response."""
    narrow = records.select("key", "record_id", "payload_digest", "payload_bytes")
    # a struct's smallest value is found by sums in each task first; null keys come last
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "record_id")).alias("first")
    copies = narrow.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(first, F.count("*").alias("copies"))
    copies = copies.where("copies > 1 and first.key is not null").select("payload_digest", "copies", F.col("first.key").alias("refers_to"), F.col("first.record_id").alias("refers_to_id"))
    told = split_join(narrow, mark_hot(copies, "copies"), ["payload_digest"])
    told = told.where(F.col("copies").isNotNull() & (F.col("payload_bytes") >= REVISIT_BYTES) & (F.col("record_id") != F.col("refers_to_id")))
    return records.join(told.select("record_id", "refers_to", "refers_to_id"), "record_id", "left")


def warc_record(row: dict) -> bytes:
    """One WARC record of a row of revisits(); a revisit holds the header of its message only."""
    again = row["refers_to_id"] is not None
    block = row["http"] + (b"" if again else row["payload"])
    head = {"WARC-Type": "revisit" if again else row["kind"], "WARC-Record-ID": f"<{row['record_id']}>", "WARC-Date": row["date"]}
    if row["url"] is not None:
        head["WARC-Target-URI"] = row["url"]
    head |= {"WARC-IP-Address": row["ip"], "WARC-Payload-Digest": f"sha256:{row['payload_digest']}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}"}
    if again:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<{row['refers_to_id']}>", "X-Refers-To-Key": str(row["refers_to"])}
    head |= {"Content-Type": "application/http; msgtype=response" if row["http"] else row["mime"], "Content-Length": str(len(block))}
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the rows of revisits() as gzipped WARC files, a member for each record; returns the manifest."""
    folder = folder or scratch_path(records.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_shared(folder)
        out, n, path = None, 0, f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                out.write(gzip.compress(warc_record(row), compresslevel=4, mtime=0))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path if "://" not in folder else f"{folder.split('://')[0]}://{path}"], "records": pa.array([n], pa.int64())})

    path = scratch_path(records.sparkSession, "manifest")
    records.mapInArrow(write, MANIFEST).write.parquet(path)  # writing is an action: the manifest is what it leaves
    return records.sparkSession.read.schema(MANIFEST).parquet(path)


# ---- reading ----

def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an uncompressed stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if line != VERSION:
            raise ValueError(f"no WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        size = int(head["Content-Length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"{head.get('WARC-Record-ID')} declares {size} bytes and has {len(block)}")
        yield head, block


def read_warc(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives (see READ); digests of blocks and of payloads that are there are checked."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                fs, path = open_shared(file["path"])
                rows, seen = [], 0
                with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, block in parse_warc(io.BufferedReader(stream, 1 << 20)):
                        fields, _, payload = _http(block)
                        again, digest = head["WARC-Type"] == "revisit", head["WARC-Payload-Digest"].partition(":")[2]
                        if head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or not again and digest != hashlib.sha256(payload).hexdigest():
                            raise ValueError(f"{path}: {head['WARC-Record-ID']} doesn't have its digest")
                        rows.append({"key": int(fields[KEY_HEADER]) if KEY_HEADER in fields else None, "record_id": head["WARC-Record-ID"].strip("<>"), "url": head.get("WARC-Target-URI"),
                                     "date": head["WARC-Date"], "record_type": head["WARC-Type"], "payload": payload if payloads and not again else None,
                                     "payload_bytes": int(fields.get("Content-Length", len(payload))), "payload_digest": digest,
                                     "refers_to": int(head["X-Refers-To-Key"]) if again else None, "refers_to_id": head["WARC-Refers-To"].strip("<>") if again else None})
                        if len(rows) == 256:
                            seen += len(rows)
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                if seen + len(rows) != file["records"]:
                    raise ValueError(f"{path} has {seen + len(rows)} of {file['records']} records")

    return manifest.repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInArrow(read, READ)


_READ = pa.schema([("key", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string())])


def archive(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Rows to legacy archives, to WARC archives; returns the manifest of the latter.

    The legacy archives are written first: their names and offsets make the record ids, so they must not change.
    """
    return write_warc(revisits(convert(stored(to_arc(pages, key, url, html), "arc"))))
