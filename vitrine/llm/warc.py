"""WARC archives: writing pages as records, and a sequential reader.

Archives hold one gzip member per record. The reader feeds an archive to zlib piece by piece, so that it never holds more
than one record; frames each record by its Content-Length; and verifies block and payload digests. A record whose payload
equals that of another page is written as a revisit record (identical payload digest), which names the response record.

Scale: pages are joined to the payloads that occur more than once on the payload's digest. Payloads below
``least_revisit_bytes`` have no such key and are dealt out by their page. A payload that a third of the pages share is
pre-aggregated to one row before the join, and Spark splits its partition of pages (a sort-merge join with skew
handling). Each task writes archives of at most about ``archive_bytes``, streaming. They go to a shared folder under a
name made of the partition and number, first to a temporary name, then renamed: a retried task replaces the same file by
the same content, and half a file is never read.

Edge cases: a NULL payload is empty; NULL ids and urls come back as NULL; rows with the same id and payload are all
responses; a record that is cut off or fails its digest is reported in ``problem``, and reading goes on behind it where
the next member can be found; an empty table makes no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote, urlsplit
from urllib.request import url2pathname

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.storage import new_folder
from vitrine.llm.text import slices
from vitrine.operators.joins import lookup

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no crawl time.
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_ID = "urn:page:"
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "archive string, position long, record_id string, type string, url string, page_id long, refers_to string, payload binary, "
    "payload_bytes long, payload_digest string, problem string"
)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member. With ``refers_to`` a revisit: no payload, but its length and digest."""
    block = _HTTP + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        # Line ends, blanks and other characters that a header cannot hold are escaped; the reader undoes it.
        *([] if url is None else [("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~"))]),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Payload-Length", str(len(payload))),
        ("WARC-Block-Digest", _sha1(block)),
        *([] if refers_to is None else [("WARC-Refers-To", f"<{_ID}{refers_to}>"), ("WARC-Profile", PROFILE)]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), url2pathname(urlsplit(folder).path)
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def write_archives(folder: str, archive_bytes: int):
    """Writes rows (page_id, url, payload, refers_to) as archives; returns a row for each archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        number, done, out, temporary, final, size, records = 0, [], None, "", "", 0, 0

        def close() -> None:
            nonlocal out, number
            if out is not None:
                out.close()
                store.move(temporary, final)
                done.append((f"{folder.rstrip('/')}/{os.path.basename(final)}", records, size))
                out, number = None, number + 1

        for batch in slices(batches, "payload", 4 << 20):
            for page, url, payload, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                if out is None:
                    final = f"{root}/part-{task.partitionId():06d}-{number:04d}.warc.gz"
                    temporary = f"{final}.{task.taskAttemptId()}.tmp"
                    out, size, records = store.open_output_stream(temporary, compression=None), 0, 0
                member = record(page, url, payload or b"", refers)
                out.write(member)
                size += len(member)
                records += 1
                if size >= archive_bytes:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*done, strict=True)], ["path", "records", "bytes"])

    return write


def members(data: memoryview, piece: int = 1 << 16) -> Iterator[tuple[int, bytes | None]]:
    """Place and content of each gzip member; None for one that is cut off or broken."""
    at = 0
    while at < len(data):
        unpacker, begin, parts = zlib.decompressobj(31), at, []
        try:
            while at < len(data) and not unpacker.eof:
                got = data[at : at + piece]
                parts.append(unpacker.decompress(got))
                at += len(got) - len(unpacker.unused_data)
        except zlib.error:
            parts = None
        if parts is None or not unpacker.eof:
            yield begin, None
            found = bytes(data[begin + 1 :]).find(b"\x1f\x8b\x08")  # a broken member: go on at the next one's mark
            if found < 0:
                return
            at = begin + 1 + found
        else:
            yield begin, b"".join(parts)


def parse(content: bytes) -> dict:
    """The record in a member: its fields, and its payload where it has one. ``problem`` says what is wrong, if anything."""
    head, mark, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    out = {"type": fields.get("warc-type"), "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None}
    out |= {"record_id": fields.get("warc-record-id", "").strip("<>"), "refers_to": fields.get("warc-refers-to", "").strip("<>") or None}
    if not mark or not lines[0].startswith("WARC/1.") or not fields.get("content-length", "").isdigit():
        return out | {"problem": "no record header"}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) < size or rest[size:] != b"\r\n\r\n":
        return out | {"problem": "block does not fit its length"}
    if "warc-block-digest" in fields and fields["warc-block-digest"] != _sha1(block):
        return out | {"problem": "block digest differs"}
    payload = block.partition(b"\r\n\r\n")[2] if "application/http" in fields.get("content-type", "") else block
    named = fields.get("warc-payload-digest")
    if out["type"] == "revisit":
        out |= {"payload_bytes": int(fields.get("warc-payload-length", 0)), "payload_digest": _hex(named)}
    else:
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
        if named and named != _sha1(payload):
            out["problem"] = "payload digest differs"
    return out


def _hex(digest: str | None) -> str | None:
    return base64.b32decode(digest.partition(":")[2]).hex() if digest else None


def _page(identity: str | None) -> int | None:
    name = (identity or "").removeprefix(_ID)
    return int(name) if name.removeprefix("-").isdigit() else None


def _records(path: str, content: memoryview) -> Iterable[dict]:
    for place, member in members(content):
        found = parse(member) if member is not None else {"problem": "broken gzip member"}
        yield {"archive": path, "position": place, "page_id": _page(found.get("record_id"))} | found


def read_archives(spark: SparkSession, paths: str | list[str], with_payload: bool = True) -> DataFrame:
    """All records of archives, in their order within each archive. Spark's reader opens the files, wherever they are."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, held = [], 0
                for row in _records(path.as_py(), memoryview(content.as_buffer())):
                    held += len(row.get("payload") or b"")
                    if not with_payload:
                        row.pop("payload", None)
                    rows.append(row)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(paths)
    return files.select("path", "content").mapInArrow(read, RECORDS)


def archive_pages(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least_revisit_bytes: int = 1000, archive_bytes: int = 8 << 20
) -> DataFrame:
    """Writes all pages to ``folder``; a row for each archive. Runs when it is called."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    key = F.when(F.length("payload") >= least_revisit_bytes, F.sha1("payload"))
    shared = rows.select(key.alias("digest"), "page_id").where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
    keyed = rows.withColumn("digest", F.coalesce(key, F.concat(F.lit("page "), F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    dealt = lookup(keyed, shared.select("digest", "response"), ["digest"])  # a payload that a third of the pages share can be split
    refers = F.when(F.col("page_id") < F.col("response"), F.col("response"))
    manifest = dealt.select("page_id", "url", "payload", refers.alias("refers_to")).mapInArrow(write_archives(folder, archive_bytes), MANIFEST)
    manifest.write.parquet(f"{folder.rstrip('/')}-manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}-manifest")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes pages to new archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    if not archive_pages(pages, folder, **options).take(1):
        return spark.createDataFrame([], RECORDS)
    return read_archives(spark, folder, with_payload=False)


def digest(records: DataFrame) -> DataFrame:
    """What the records of pages say, without their payloads."""
    whole = F.when(F.col("problem").isNull(), F.col("type")).otherwise(F.raise_error(F.concat_ws(" ", "archive", "position", "problem")))
    refers = F.when(F.col("type") == "revisit", F.regexp_extract("refers_to", f"^{_ID}(-?[0-9]+)$", 1).cast("long"))
    return records.select("page_id", "payload_bytes", "payload_digest", whole.alias("record_type"), refers.alias("refers_to"))
