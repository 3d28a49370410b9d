"""WARC: sequential writer and reader, one gzip member per record.

``write_warc`` turns page rows into ``.warc.gz`` archives in a shared folder
and returns the committed manifest; ``read_warc`` reads archives back record
by record: zlib inflates one member at a time in small chunks, Content-Length
frames the block, and the payload is hashed while it passes and compared with
the record's digest.  Equal payloads of at least ``min_revisit_bytes`` are
stored once; later pages are ``revisit`` records that refer to it.

A writing task names its files after its own attempt and reports them in its
rows; only the rows of committed attempts reach the manifest, so a task that
is lost and run again leaves no half-written archive in use.

Edge cases: null html is an empty payload; a null page_id is written as a
record without page header and read back as null; page rows that share the
smallest page_id of their payload are all responses; an empty table gives no
archives and no records; a damaged archive raises, with its path and offset.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm.common import scratch, written

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
CHUNK = 64 << 10
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, "
               "record_type string, refers_to long")


def open_fs(uri: str):
    """(filesystem, path) of a folder or file URI, for tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def encode_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>",
            f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


class Record:
    """Incremental parser of one record: header, then a block framed by
    Content-Length, whose payload is hashed as it passes."""

    def __init__(self, keep_payload: bool):
        self.buffer, self.tail, self.fields, self.http = b"", b"", None, None
        self.left, self.sha, self.seen, self.kept = 0, hashlib.sha256(), 0, [] if keep_payload else None

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.buffer += data
            head, mark, rest = self.buffer.partition(b"\r\n\r\n")
            if not mark:
                return
            lines = head.decode("utf-8").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            self.left, self.buffer, data = int(self.fields["content-length"]), b"", rest
        block, tail = data[:self.left], data[self.left:]
        self.left -= len(block)
        self.tail += tail
        if not b"\r\n\r\n".startswith(self.tail):
            raise ValueError("bytes after the end of the block")
        if self.http is None:
            self.buffer += block
            head, mark, block = self.buffer.partition(b"\r\n\r\n")
            if not mark:
                return
            self.http = {k.strip().lower(): v.strip() for k, _, v in
                         (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])}
        if block:
            self.sha.update(block)
            self.seen += len(block)
            if self.kept is not None:
                self.kept.append(block)

    def close(self) -> dict:
        if self.fields is None or self.http is None or self.left:
            raise ValueError("record ends before its Content-Length")
        kind = self.fields["warc-type"]
        digest = self.fields["warc-payload-digest"].removeprefix("sha256:")
        length = int(self.http["content-length"])
        if kind == "response" and (self.sha.hexdigest() != digest or self.seen != length):
            raise ValueError("payload does not match its digest")
        number = lambda k: int(self.fields[k]) if k in self.fields else None
        out = {"page_id": number("x-page-id"), "url": self.fields.get("warc-target-uri"), "payload_bytes": length,
               "payload_digest": digest, "record_type": kind, "refers_to": number("x-refers-to-page")}
        if self.kept is not None:
            out["payload"] = b"".join(self.kept) if kind == "response" else None
        return out


def iterate_records(stream, keep_payload: bool = False):
    """Records of one archive, in order, one gzip member after the other."""
    at, pending = 0, stream.read(CHUNK)
    while pending:
        start, inflate, record = at, zlib.decompressobj(31), Record(keep_payload)
        try:
            while True:
                if not pending:
                    raise ValueError("archive ends inside a gzip member")
                record.feed(inflate.decompress(pending, CHUNK * 4))
                at += len(pending) - len(inflate.unconsumed_tail) - len(inflate.unused_data)
                if inflate.eof:
                    pending = inflate.unused_data or stream.read(CHUNK)
                    break
                pending = inflate.unconsumed_tail or stream.read(CHUNK)
            yield record.close()
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"damaged record at byte {start}: {e}") from e


def plan_records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest, refers_to: who answers and who revisits.

    Digests, not payloads, are grouped; the revisits (without html) are then
    joined to the pages by page and digest, so a payload that a third of all
    pages share is no hot key there."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    light = rows.select("page_id", "digest", F.octet_length("html").alias("bytes"))
    firsts = (light.where(F.col("bytes") >= min_revisit_bytes)
              .groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    revisits = (light.where(F.col("bytes") >= min_revisit_bytes).join(firsts, "digest")
                .where("page_id <> refers_to")
                .groupBy("page_id", "digest").agg(F.min("refers_to").alias("refers_to")))
    return rows.join(revisits, ["page_id", "digest"], "left")


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives of ``pages`` below ``folder``; the manifest
    (path, records, bytes) of what was committed."""
    planned = plan_records(pages, min_revisit_bytes)

    def write(batches):
        import pyarrow as pa

        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        out, path, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for p, url, html, digest, to in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                                  for c in ("page_id", "url", "html", "digest", "refers_to"))):
                if out is None:
                    path, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                data = encode_record(p, url, html.encode("utf-8"), digest, to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{os.path.basename(path)}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{os.path.basename(path)}", records, size))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [x[0] for x in done], "records": [x[1] for x in done],
                                              "bytes": [x[2] for x in done]})

    return written(planned.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_warc(spark: SparkSession, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives whose ``path`` the manifest lists, one task
    per few archives; with their payloads if asked."""
    def read(batches):
        import pyarrow as pa

        names = [f.split()[0] for f in READ_SCHEMA.split(", ")] + ["payload"] * with_payload
        kinds = {"url": pa.string(), "payload_digest": pa.string(), "record_type": pa.string(), "payload": pa.binary()}
        batch_of = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = open_fs(path)
                rows, held = [], 0
                with fs.open_input_stream(at, compression=None) as stream:
                    for r in iterate_records(stream, with_payload):
                        rows.append(r)
                        held += len(r.get("payload") or b"")
                        if len(rows) == 2000 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    paths = manifest.select("path")
    n = paths.count()
    paths = paths.repartition(max(1, min(n, 4 * spark.sparkContext.defaultParallelism) if n < 100_000 else n // 8), "path")
    return paths.mapInArrow(read, READ_SCHEMA + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` and read them back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, scratch(spark, "warc")))
