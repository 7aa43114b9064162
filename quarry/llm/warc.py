"""WARC archives: one gzip member per record, read back sequentially.

Writing: every row becomes a ``response`` record (HTTP header and payload)
or, when another row with the same payload is its response, a ``revisit``
record (HTTP header only) that refers to it.  A task writes its rows to
archives of about ``archive_bytes`` each, under names of its own attempt;
only the archives of attempts that Spark commits are in the manifest, so a
lost or repeated task leaves at most files that nobody reads.

Reading: one task per archive reads it front to back in small chunks.  Each
gzip member is inflated as its bytes arrive, the header ends at the first
empty line, ``Content-Length`` frames the block, two line ends must follow
and then the member must end; payload and block digests are computed on the
way and compared with the header.  Memory holds a chunk and one record.

Archives go through ``pyarrow.fs`` (file, hdfs, s3, gs paths); the folder
must be one that all executors reach, such as ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, small_batches

LINE = b"\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the rows carry no capture time
CHUNK = 1 << 16


class WarcError(ValueError):
    """An archive breaks the format, or a digest does not match."""


def sha1_label(digest: bytes) -> bytes:
    return b"sha1:" + base64.b32encode(digest)


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def target(page_id, url: str | None) -> str:
    """The url with everything that may not stand in a header percent-coded."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{'' if page_id is None else page_id}"


def write_record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False, level: int = 6) -> bytes:
    """One record as a gzip member."""
    http = LINE.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: " + str(len(payload)).encode(), b"", b""])
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target(page_id, url)),
        ("WARC-Payload-Digest", sha1_label(hashlib.sha1(payload).digest()).decode()),
        ("WARC-Block-Digest", sha1_label(hashlib.sha1(block).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", IDENTICAL)]
    head = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + LINE
    z = zlib.compressobj(level, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return z.compress(head) + z.compress(block) + z.compress(LINE + LINE) + z.flush()


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator of inflated pieces
    that must be used up before the next one is asked for."""
    rest, ended = b"", False

    def more() -> bytes:
        nonlocal ended
        for c in chunks:
            if c:
                return c
        ended = True
        return b""

    while True:
        if not rest:
            rest = more()
        if ended:
            return

        def inflate():
            nonlocal rest
            z = zlib.decompressobj(16 + zlib.MAX_WBITS)
            while not z.eof:
                if not rest and not z.unconsumed_tail:
                    rest = more()
                    if ended:
                        raise WarcError("the archive ends within a member")
                data, rest = z.unconsumed_tail + rest, b""
                try:
                    yield z.decompress(data, CHUNK)
                except zlib.error as e:
                    raise WarcError(f"damaged member: {e}") from e
            rest = z.unused_data

        yield inflate()


class Cursor:
    """Reads a member by line and by length; never looks back."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.buffer = pieces, bytearray()

    def fill(self) -> bool:
        for p in self.pieces:
            if p:
                self.buffer += p
                return True
        return False

    def line(self) -> bytes:
        seen = 0
        while (at := self.buffer.find(LINE, max(seen - 1, 0))) < 0:
            seen = len(self.buffer)
            if not self.fill():
                raise WarcError("a header line does not end")
        out = bytes(self.buffer[:at])
        del self.buffer[:at + 2]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.fill():
                raise WarcError("the block is shorter than its Content-Length")
            part = bytes(self.buffer[:n])
            del self.buffer[:len(part)]
            n -= len(part)
            yield part

    def end(self) -> None:
        if b"".join(self.take(4)) != LINE + LINE or self.buffer or self.fill():
            raise WarcError("a record does not end where its Content-Length says")


def header(cursor: Cursor) -> dict[str, str]:
    out = {}
    while raw := cursor.line():
        name, colon, value = raw.partition(b":")
        if not colon:
            raise WarcError(f"not a header line: {raw[:80]!r}")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def read_records(chunks: Iterator[bytes], payloads: bool = True) -> Iterator[dict]:
    """The records of an archive, verified, in order.  ``payload_digest`` is
    the hex SHA-1 of the full payload, ``payload_bytes`` its length; a revisit
    has these of its response and no ``payload``."""
    for member in members(chunks):
        cursor = Cursor(member)
        version = cursor.line()
        if not version.startswith(b"WARC/"):
            raise WarcError(f"not a record: {version[:40]!r}")
        h = header(cursor)
        try:
            length = int(h["content-length"])
            kind = h["warc-type"]
            claimed = h["warc-payload-digest"], h["warc-block-digest"]
        except (KeyError, ValueError) as e:
            raise WarcError(f"a record lacks a valid {e}") from e
        block, body, parts, http = hashlib.sha1(), hashlib.sha1(), [], bytearray()
        n_body, in_body = 0, False
        for part in cursor.take(length):
            block.update(part)
            if not in_body:
                http += part
                at = http.find(LINE + LINE)
                if at < 0:
                    continue
                part, http, in_body = bytes(http[at + 4:]), http[:at], True
            body.update(part)
            n_body += len(part)
            if payloads:
                parts.append(part)
        cursor.end()
        if sha1_label(block.digest()).decode() != claimed[1]:
            raise WarcError("the block does not match its digest")
        if kind == "response":
            if sha1_label(body.digest()).decode() != claimed[0]:
                raise WarcError("the payload does not match its digest")
        else:
            lengths = [x.split(b":", 1)[1] for x in http.split(LINE) if x.lower().startswith(b"content-length:")]
            n_body = int(lengths[0]) if lengths else 0
        page = h["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
        refers = h.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
        yield {"page_id": int(page) if page else None, "target_uri": h.get("warc-target-uri"), "record_type": kind,
               "payload_bytes": n_body, "payload_digest": base64.b32decode(claimed[0][5:]).hex(),
               "refers_to": int(refers) if refers else None,
               "payload": b"".join(parts) if payloads and kind == "response" else None}


def filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def with_response(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, url, html`` and ``refers_to``: the largest page_id among rows
    of equal payload (of ``min_bytes`` at least) if that is another row's, else
    null.  Only digests are grouped; groups of one are left out of the join."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    keyed = base.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn(
        "size", F.octet_length("html"))
    groups = (keyed.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    met = keyed.join(groups, ["digest", "size"], "left")
    other = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return met.select("page_id", "url", "html", F.when(other, F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, archive_bytes: int = 32 << 20) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as ``.warc.gz`` files below ``folder``
    and return the manifest ``path, records, bytes`` (stored beside them).

    Null html is an empty payload; a null url gets a ``urn:page`` target; rows
    without a page_id come after all others when a response is chosen, and
    rows that repeat the largest page_id are all responses.
    """
    import pyarrow as pa

    def run(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, path, n, size, done = None, None, 0, 0, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in (0, 1, 3)]
            for i, (page, url, refers) in enumerate(zip(*cols)):
                if out is None:
                    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = fs.open_output_stream(path), 0, 0
                payload = b.column(2)[i].as_py().encode("utf-8", "replace")
                raw = write_record(page, url, payload, refers, refers is not None)
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "records", "bytes"])

    manifest = small_batches(with_response(pages, min_bytes)).mapInArrow(run, "path string, records long, bytes long")
    manifest.write.parquet(f"{folder}/manifest")
    return manifest.sparkSession.read.schema("path string, records long, bytes long").parquet(f"{folder}/manifest")


RECORD_SCHEMA = ("page_id long, target_uri string, record_type string, payload_bytes long, payload_digest string, "
                 "refers_to long, payload binary")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives of a manifest (:data:`RECORD_SCHEMA`); a
    damaged archive fails the job with :class:`WarcError`."""
    import pyarrow as pa

    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        fs, _ = filesystem(folder)

        def emit(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

        for b in batches:
            for path, expected in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, rows, size = 0, [], 0
                with fs.open_input_stream(path) as f:
                    for r in read_records(iter(lambda f=f: f.read(CHUNK), b""), payloads):
                        rows.append(r)
                        n, size = n + 1, size + len(r["payload"] or b"") + 200
                        if size >= 4 << 20:
                            yield emit(rows)
                            rows, size = [], 0
                if rows:
                    yield emit(rows)
                if n != expected:
                    raise WarcError(f"{path}: {n} records, {expected} were written")

    # The manifest has a row for each archive: deal them out one by one.
    tasks = max(1, min(manifest.count(), 100_000))
    return manifest.select("path", "records").repartition(tasks, "path").mapInArrow(run, RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 1000) -> DataFrame:
    """Write all pages, read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    return read_archives(manifest, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
