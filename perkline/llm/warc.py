"""Web archives: writing WARC records with revisits of equal payloads, and a sequential reader."""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.session import scratch_path, stage_table

LEAST_BYTES = 100
ROLL_BYTES = 64 << 20
READ_BYTES = 256 << 10
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: Algorithms of digests and the bytes of each.
DIGESTS = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}
MANIFEST = "path string, records long, bytes long"


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _clean(value: object) -> str:
    return " ".join(str(value).split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit with the response's header only."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Refers-To-Page-Id", refers_to)]
    fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    """``data`` as one gzip member, without a time stamp."""
    pack = zlib.compressobj(2, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def members(stream: BinaryIO) -> Iterator[tuple[int, Iterator[bytes]]]:
    """The gzip members of a stream as (offset, pieces of content), decompressed piece by piece."""
    at, rest = 0, stream.read(READ_BYTES)

    def pieces() -> Iterator[bytes]:
        nonlocal at, rest
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            if not rest and not (rest := stream.read(READ_BYTES)):
                raise ValueError(f"the member at byte {at} is cut off")
            size = len(rest)
            piece = unpack.decompress(rest, 4 * READ_BYTES)
            rest = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            at += size - len(rest)
            if piece:
                yield piece

    while rest or (rest := stream.read(READ_BYTES)):
        yield at, pieces()


def header(lines: bytes) -> dict[str, str]:
    """Fields of a record or message by lower-case name, without the first line; folded lines count to the line before."""
    unfolded = re.sub(r"\r\n[ \t]+", " ", lines.decode("utf-8", "replace"))
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in unfolded.split("\r\n")[1:])}


def stated_digest(field: str) -> tuple[str, bytes] | None:
    """Algorithm and value of a digest in hex or base32; None if the algorithm is not at hand."""
    name, _, value = field.partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip()
    if name not in DIGESTS:
        return None
    try:
        if len(value) == 2 * DIGESTS[name]:
            return name, bytes.fromhex(value)
        found = base64.b32decode(value.rstrip("=") + "=" * (-len(value.rstrip("=")) % 8), casefold=True)
    except (ValueError, binascii.Error):
        found = b""
    if len(found) != DIGESTS[name]:
        _fail(f"an unreadable digest: {field[:80]}")
    return name, found


def agrees(field: str | None, *candidates: bytes) -> bool:
    """Whether one of the candidates has the digest; without a digest that can be verified, any has."""
    stated = stated_digest(field) if field else None
    return stated is None or any(hashlib.new(stated[0], c).digest() == stated[1] for c in candidates)


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record, framed by its content length.

    Records of any writer of versions 0.17 to 1.1 will do; a block digest is verified if there is one.
    """
    buffer, seen = bytearray(), 0
    while (end := buffer.find(END, max(0, seen - len(END)))) < 0:
        seen = len(buffer)
        buffer += next(pieces, b"") or _fail("a record without end of header")
    first = bytes(buffer[:end]).split(b"\r\n", 1)[0]
    if not re.fullmatch(rb"WARC/(0\.1[78]|1\.[01])", first):
        _fail(f"no record of a known version: {first[:40].decode('utf-8', 'replace')}")
    fields = header(bytes(buffer[:end]))
    size = int(fields["content-length"])
    for piece in pieces:
        buffer += piece
    block = bytes(buffer[end + 4:end + 4 + size])
    if len(block) < size or bytes(buffer[end + 4 + size:]) != END:
        _fail("a block that differs from its content length")
    if not agrees(fields.get("warc-block-digest"), block):
        _fail("a block that differs from its digest")
    return fields, block


def unchunked(body: bytes) -> bytes | None:
    """A body in chunked transfer coding without it; None if it isn't one."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = body[at:end].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + n])
        if len(out[-1]) < n:
            return None
        at = end + 4 + n
    return None


def content(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int | None, str | None]:
    """Payload of a record, its size, and its digest as the reader reports it.

    The payload of an HTTP message is its body, of other records the block; a revisit has none but may state size and
    digest. A payload digest is verified on the body as stored or without its transfer coding, but not if the record
    holds a part of the payload only.
    """
    digest, http = fields.get("warc-payload-digest"), {}
    payload = raw = block
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, raw = block.partition(END)
        http = header(head)
        payload = raw
        if "chunked" in http.get("transfer-encoding", "").lower():
            whole = unchunked(raw)
            payload = raw if whole is None else whole
    if fields["warc-type"] == "revisit":
        stated, size = stated_digest(digest) if digest else None, http.get("content-length", "")
        known = None if stated is None else ("" if stated[0] == "sha256" else f"{stated[0]}:") + stated[1].hex()
        return None, int(size) if re.fullmatch(r"[0-9]{1,18}", size) else None, known
    partial = "warc-truncated" in fields or "warc-segment-number" in fields
    own = hashlib.sha256(payload)
    if not partial and digest and stated_digest(digest) != ("sha256", own.digest()) and not agrees(digest, payload, raw):
        _fail("a payload that differs from its digest")
    return payload, len(payload), own.hexdigest()


def _fail(what: str) -> bytes:
    raise ValueError(what)


def _write(folder: str, date: str, roll_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        stem = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        done: list[tuple[str, int, int]] = []
        sink, records, size = None, 0, 0
        for batch in batches:
            ids, urls, texts, digests, refers = (c for c in batch.columns)
            for i in range(batch.num_rows):
                if sink is None:
                    name = f"{stem}-{len(done):04d}.warc.gz"
                    sink, records, size = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                text = texts[i].as_buffer()
                data = member(record(ids[i].as_py(), urls[i].as_py(), text.to_pybytes() if text else b"",
                                     digests[i].as_py(), refers[i].as_py(), date))
                sink.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll_bytes:
                    sink.close()
                    done.append((f"{folder}/{name}", records, size))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((f"{folder}/{name}", records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["path", "records", "bytes"])
    return run


def write_archives(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least_bytes: int = LEAST_BYTES,
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the stored manifest of the archives.

    Payloads are the UTF-8 bytes of html, null as empty. Of equal payloads of ``least_bytes`` or more the
    smallest page_id is the response and the others are revisits of it; smaller ones are all responses.
    Rows that repeat the smallest id are responses each. A null page_id is no one's reference: its record
    is a revisit if its payload has a response, else a response. An empty table gives no archives.

    The choice is made on digests, pre-aggregated; only repeated digests are joined. A task writes archives
    of about ``roll_bytes`` under names of its own attempt, and the manifest lists those of the attempts that
    Spark committed, so what a lost task left behind is never read.
    """
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digest = F.sha2("html", 256)
    key = F.when(F.octet_length("html") >= least_bytes, digest)
    first = stage_table(
        base.select("page_id", key.alias("same")).filter("same is not null").groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("same", "first"), "repeated")
    refers: Column = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = (
        base.withColumn("digest", digest)
        .withColumn("own", F.when(F.octet_length("html") >= least_bytes, F.col("digest")))
        .join(first, F.col("own") == F.col("same"), "left")
        .select("page_id", "url", "html", "digest", refers.alias("refers_to")))
    folder = scratch_path(pages.sparkSession, "warc")
    return stage_table(rows.mapInArrow(_write(folder, date, roll_bytes), MANIFEST), "warc_manifest")


def _read(with_payload: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(path: str) -> Iterator[dict]:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_stream(place, compression=None, buffer_size=0) as stream:
            for offset, pieces in members(stream):
                try:
                    fields, block = read_record(pieces)
                    body, size, digest = content(fields, block)
                except (ValueError, KeyError, zlib.error) as error:
                    raise ValueError(f"{path}, record at byte {offset}: {error}") from error
                row = {
                    "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
                    "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
                    "record_type": fields["warc-type"],
                    "refers_to": int(fields["x-refers-to-page-id"]) if "x-refers-to-page-id" in fields else None,
                    "record_id": fields.get("warc-record-id"), "refers_to_record": fields.get("warc-refers-to"),
                    "path": path, "offset": offset}
                yield row | {"payload": body} if with_payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _SCHEMA if with_payload else _SCHEMA.remove(_SCHEMA.get_field_index("payload"))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows(path):
                    held.append(row)
                    size += 400 + (len(row["payload"] or b"") if with_payload else 0)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)
    return run


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_record", pa.string()), ("path", pa.string()), ("offset", pa.int64()),
    ("payload", pa.binary())])


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the archives in column ``path``, one task per archive, read member by member.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to, record_id, refers_to_record, path, offset,
    payload). Archives of other writers will do, with one gzip member per record: all record types come as rows, page
    ids are null. ``payload_digest`` is the hex SHA-256 of the payload; a revisit has a null payload, the size that its HTTP
    header states, and the digest that it states, in hex and behind ``algorithm:`` if that is not SHA-256. Framing is
    verified, and what digests there are; a damaged archive ends the job with its path and byte. No archives
    give an empty result.
    """
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, record_id string, refers_to_record string, path string, offset long"
              + (", payload binary" if payload else ""))
    paths = manifest.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(_read(payload), schema)
