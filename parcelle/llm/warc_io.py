"""WARC archives: a writer with payload deduplication and a sequential reader.

Archives hold one gzip member per record. The writer runs in the tasks that hold the pages, rolls over at
``max_bytes``, and writes through ``pyarrow.fs`` into the shared folder, so any store that pyarrow opens
serves. A retried task writes under a new name; only archives named in the written index are read.

The reader streams an archive: incremental zlib decompression, Content-Length framing, digest check of block
and payload. It holds one record at a time. One archive is one unit of work; archives are bounded by
``max_bytes`` plus one record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm.common import materialise, new_folder, place

# fixed values of the WARC format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT, RESPONSE = "revisit", "response"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line: control characters, spaces, percent signs and non-ASCII as %XX."""
    return re.sub(r"[^!-$&-~]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8", "surrogatepass")), value)


def _unline(value: str) -> str:
    raw = re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m.group(1), 16)]), value.encode())
    return raw.decode("utf-8", "surrogatepass")


def record(page: int | None, url: str | None, payload: bytes, refers_to: tuple | None, tie: str, date: str) -> bytes:
    """One record as a gzip member. ``refers_to``: (page, tie) of the response that a revisit repeats."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    name = lambda p, t: f"<urn:page:{'' if p is None else p}:{t}>"
    head = ["WARC/1.1", f"WARC-Type: {REVISIT if refers_to else RESPONSE}", f"WARC-Record-ID: {name(page, tie)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to:
        head += [f"WARC-Refers-To: {name(*refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


class Corrupt(ValueError):
    """An archive that breaks the format or a digest."""


def members(stream, chunk: int = 1 << 20):
    """The decompressed gzip members of a stream, one after the other; input is taken chunk by chunk."""
    data = stream.read(chunk)
    while data:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not data:
                raise Corrupt("the archive ends inside a record")
            out.append(z.decompress(data))
            data = z.unused_data if z.eof else stream.read(chunk)
        yield b"".join(out)
        if not data:
            data = stream.read(chunk)


def parse(member: bytes) -> dict:
    """Headers, HTTP payload and digests of one record; raises ``Corrupt`` if framing or digests do not hold."""
    head, sep, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise Corrupt("no WARC header")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    block, end = rest[:n], rest[n:]
    if len(block) != n or end != b"\r\n\r\n":
        raise Corrupt("Content-Length does not frame the block")
    if fields.get("warc-block-digest", "sha1:" + digest(block)) != "sha1:" + digest(block):
        raise Corrupt("block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == RESPONSE:
        length = len(payload)
        if fields["warc-payload-digest"] != "sha1:" + digest(payload):
            raise Corrupt("payload digest")
    else:
        payload, length = None, int(re.search(rb"(?i)\r\nContent-Length: *(\d+)", http).group(1))
    page = lambda v: int(v.split(":")[2]) if v and v.split(":")[2] else None
    uri = fields.get("warc-target-uri")
    return {"page_id": page(fields["warc-record-id"]), "url": None if uri is None else _unline(uri), "record_type": fields["warc-type"],
            "payload": payload, "payload_bytes": length, "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
            "refers_to": page(fields.get("warc-refers-to", ""))}


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, max_bytes: int = 128 << 20,
                   date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   stored: bool = False) -> DataFrame:
    """Write a record per page; returns the index (archive, records, bytes), already materialised.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest id (nulls last; of
    repeated rows the one with the least place) is the response and the others are revisits. Only digests are
    grouped; the pages meet the digests that occur more than once in an equi-join, whose hot keys adaptive
    execution splits. Null html: empty payload. Null url: no target header. Other columns are not read.
    ``stored`` says that ``pages`` is a scan of a Parquet table, filtered or not; anything else is written first.
    """
    if not stored:
        pages = materialise(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), "pages")
        id_col, url_col, html_col = "page_id", "url", "html"
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), place(pages).alias("tie"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("sha"))
    first = (rows.where(F.octet_length("html") >= min_bytes).groupBy("sha")
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "tie")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("sha").alias("first_sha"), F.col("first.page_id").alias("first_id"), F.col("first.tie").alias("first_tie")))
    rows = rows.join(first, F.col("sha") == F.col("first_sha"), "left").select("page_id", "url", "html", "tie", "first_id", "first_tie")

    def name_of(tie):
        return f"{tie['file']}.{tie['at']}"

    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        files, path = _open(folder)
        files.create_dir(path, recursive=True)
        index, out, name, n, size = [], None, None, 0, 0
        for batch in batches:
            for page, url, html, tie, first_id, first_tie in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{len(index):05d}-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                data = record(page, url, html.encode("utf-8", "surrogatepass"),
                              None if first_tie is None or first_tie == tie else (first_id, name_of(first_tie)), name_of(tie), date)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= max_bytes:
                    out.close()
                    index.append((f"{folder}/{name}", n, size))
                    out, n, size = None, 0, 0
        if out is not None:
            out.close()
            index.append((f"{folder}/{name}", n, size))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index, strict=True) if index else [()] * 3, (pa.string(), pa.int64(), pa.int64()), strict=True)],
                                         names=["archive", "records", "bytes"])

    return materialise(rows.mapInArrow(run, "archive string, records long, bytes long"), "warc-index")


def read_archives(archives: DataFrame, payloads: bool = True, column: str = "archive") -> DataFrame:
    """The records of the archives named in ``archives``: page_id, url, record_type, payload, payload_bytes,
    payload_digest, refers_to (page id of the response that a revisit names). A broken archive raises.

    Archives are dealt one to a task.
    """
    def run(batches):
        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                files, path = _open(archive)
                found, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for member in members(stream):
                        r = parse(member)
                        held += len(member) if payloads else 400
                        if not payloads:
                            r["payload"] = None
                        found.append(r)
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(found, kinds)
                            found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, kinds)

    spark: SparkSession = archives.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    names = archives.select(column).repartitionByRange(n, column)
    return names.mapInArrow(run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def round_trip(pages: DataFrame, min_bytes: int = 0, stored: bool = False) -> DataFrame:
    """Write the archives and read them back, a row per page; ``stored`` as for ``write_archives``."""
    spark = pages.sparkSession
    index = write_archives(pages, new_folder(spark, "warc"), min_bytes, stored=stored)
    return read_archives(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
