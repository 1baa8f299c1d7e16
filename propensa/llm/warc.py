"""WARC archives: write pages as WARC/1.1 records, read archives record by record.

Writing: every record is one gzip member.  Of records with the same payload of
at least ``min_revisit`` bytes, the one with the largest page id is a
``response``, the others are ``revisit`` records that name it and carry no
payload.  Who revisits whom comes from a narrow aggregate over (digest, length)
that is combined on the map side, so a digest that a third of all pages share
costs one row per map task; the payload itself is shuffled once, by page id,
and only for the join with the (narrow) list of revisits.

Reading is sequential: bytes are fetched in chunks, inflated incrementally
member by member, framed by Content-Length, and the block and payload digests
are verified.  Memory is bounded by one chunk and one record.

Archives go below the shared folder through Arrow's file system of that
folder's URI, under a name no other attempt uses.  The manifest (archive,
records, bytes) of the tasks that succeeded is itself a table in the shared
folder, so archives of lost or repeated attempts are never read.

Edge cases: a null page body is an empty payload; a null url is written as an
empty target; rows without an id are written as well (their id field is empty)
and never serve as a revisit's target; rows with the same id and body give one
response and no self-revisit; an empty table gives no archives and no records;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, new_path

MIN_REVISIT = 1000
#: Compressed bytes after which a writer opens the next archive.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and path of a URI or plain path."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def b32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(kind: str, url: str, payload: bytes, page_id, sha1_hex: str, refers_to=None) -> bytes:
    """One WARC record, not compressed.  The block of a ``response`` is an HTTP
    head and the payload; that of a ``revisit`` is the head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head + (payload if kind == "response" else b"")
    clean = "".join(c for c in url if c >= " ")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{clean}')}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}", "Content-Type: application/http; msgtype=response",
        f"WARC-Page-ID: {'' if page_id is None else page_id}", f"WARC-Payload-Digest: {b32(sha1_hex)}",
        f"WARC-Payload-Length: {len(payload)}", f"WARC-Block-Digest: {b32(hashlib.sha1(block).hexdigest())}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Page: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as one gzip member."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class WarcError(ValueError):
    """An archive that is truncated, wrongly framed or fails a digest."""


def members(stream) -> Iterator[bytes]:
    """Inflated gzip members of a byte stream, one after the other."""
    rest, done = b"", False
    while True:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not rest:
                rest = stream.read(CHUNK)
                if not rest:
                    out.append(z.flush())
                    done = not z.eof
                    break
            out.append(z.decompress(rest, CHUNK))
            rest = z.unconsumed_tail or (z.unused_data if z.eof else b"")
        if done:
            if any(out):
                raise WarcError("the archive ends inside a record")
            return
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record; raises if the
    framing or a digest does not hold."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        raise WarcError("no WARC record")
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields["content-length"])
    block = data[end + 4:end + 4 + size]
    if len(block) != size or data[end + 4 + size:] != b"\r\n\r\n":
        raise WarcError("Content-Length does not frame the record")
    if b32(hashlib.sha1(block).hexdigest()) != fields["warc-block-digest"]:
        raise WarcError("block digest differs")
    return fields, block


def read_stream(stream) -> Iterator[dict]:
    """Records of one archive: id, url, type, payload (None for revisits), length and digest."""
    for data in members(stream):
        fields, block = parse(data)
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        kind, payload = fields["warc-type"], None
        if kind == "response":
            payload = block[block.find(b"\r\n\r\n") + 4:]
            if hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["warc-payload-length"]):
                raise WarcError("payload digest differs")
        yield {
            "page_id": int(fields["warc-page-id"]) if fields["warc-page-id"] else None, "url": fields["warc-target-uri"],
            "record_type": kind, "payload": payload, "payload_bytes": int(fields["warc-payload-length"]), "payload_digest": digest,
            "refers_to": int(fields["warc-refers-to-page"]) if kind == "revisit" else None,
        }


def body() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def digest() -> Column:
    return F.sha1(body())


def revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another one."""
    keyed = pages.where(F.col("page_id").isNotNull()).select("page_id", digest().alias("digest"), F.octet_length(body()).alias("size"))
    keyed = keyed.where(F.col("size") >= min_revisit)
    last = (keyed.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
            .where("n > 1").select("digest", "size", "refers_to"))
    return keyed.join(last, ["digest", "size"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit: int = MIN_REVISIT, level: int = 6) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder`` (a new
    one in the shared folder if not given).  Returns the manifest: archive URI,
    records, bytes."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    joined = (pages.select("page_id", "url", "html", digest().alias("digest")).join(revisits(pages, min_revisit), ["page_id", "digest"], "left")
              .select(F.col("page_id").cast("long"), "url", "html", F.col("refers_to").cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_fs(folder)
        store.create_dir(base, recursive=True)
        out, done, name, count, size = None, [], "", 0, 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", count, size))
                out = None

        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = (html or "").encode("utf-8", "surrogatepass")
                sha1 = hashlib.sha1(payload).hexdigest()
                data = member(record("response" if refers is None else "revisit", url or "", payload, page_id, sha1, refers), level)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done]) for i in range(3)], ["archive", "records", "bytes"])

    return materialize(joined.mapInArrow(run, "archive string, records long, bytes long"), "warc-manifest")


RECORD_SCHEMA = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives that ``manifest`` (archive) lists, each archive
    read sequentially by one task.  ``with_payload=False`` returns null payloads
    (they are still read and verified)."""
    names = [f.split(" ")[0] for f in RECORD_SCHEMA.split(", ")]
    n = max(1, min(2_000, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_fs(uri)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for r in read_stream(stream):
                        held += len(r["payload"] or b"")
                        if not with_payload:
                            r["payload"] = None
                        rows.append(r)
                        if held > 8 << 20 or len(rows) >= 5_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.select("archive").repartition(n, F.xxhash64("archive")).mapInArrow(run, RECORD_SCHEMA).select(*names)


def read_bytes(data: bytes) -> list[dict]:
    """Records of an archive held in memory."""
    return list(read_stream(io.BytesIO(data)))
