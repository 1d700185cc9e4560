"""WARC archives with the index written first: offset, length, URL and digest of every record.

Writers append gzip members, one per record, to archives of bounded size in the shared folder and return the index
rows. Readers take index rows sorted by file and offset, join neighbouring byte ranges into one read, and parse the
records. An archive of a failed or repeated task attempt is in no index row and is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.shared import SENT_KEYS, as_bytes, cut, fresh_path, heavy_first, over_batches, stored, table

INDEX = (
    "page_id long, url string, file string, offset long, length long, payload_bytes long, payload_digest string, "
    "record_type string"
)
#: High half of the record ids; the low half is the page id.
ID_SPACE = 0x77696C6474614C6C << 64
DATE = "2024-01-01T00:00:00Z"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.UUID(int=ID_SPACE | (page_id & (1 << 64) - 1))}>"


def _page_of(record_id: str) -> int:
    low = uuid.UUID(record_id.strip("<>").removeprefix("urn:uuid:")).int & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def _header_text(value: str) -> str:
    """A header's value on one line."""
    return " ".join(value.split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit that names the response it repeats."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _header_text(url)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of a record, headers of the HTTP message in it, and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the largest page_id with an equal payload, null for that page itself.

    A null html counts as an empty payload. Rows that share the largest page_id are all responses, and so are rows
    without a page_id and payloads under `least_bytes`. Only digests travel to find repeats; those that repeat are sent
    to all tasks if there are SENT_KEYS at most. Of more, the frequent ones are sent, and pages with other digests are
    joined to theirs by a shuffle, so copies of one page aren't one task, however many.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    sha1, long_enough = F.unhex(F.sha1(F.encode(html, "utf-8"))), F.octet_length(html) >= least_bytes
    repeated = cut(
        pages.filter(long_enough).select("page_id", sha1.alias("sha1")).groupBy("sha1")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").select("sha1", "last", "n")
    )
    is_repeat = long_enough & (F.col("page_id") != F.col("last"))
    keyed = heavy_first(pages.select("page_id", "url", "html", sha1.alias("sha1")), repeated, "sha1", "n", SENT_KEYS)
    return keyed.select("page_id", "url", "html", F.when(is_repeat, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, max_bytes: int = 256 << 20, level: int = 6) -> DataFrame:
    """Writes a record for each row of with_originals() into archives in `folder`; returns the index, not yet stored.

    Rows without a url have no target header, rows without a page_id a record id of their own; an empty payload is a
    record too, repeated rows are records each, and no rows write no archive. Other columns are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        sink, name, at = None, "", 0
        try:
            for batch in batches:
                page, url, refers = (batch.column(k).to_pylist() for k in (0, 1, 3))
                rows = []
                for p, u, payload, r in zip(page, url, as_bytes(batch.column(2)), refers, strict=True):
                    if sink is None or at >= max_bytes:
                        if sink:
                            sink.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    digest = digest_of(payload)
                    member = gzip.compress(record(p, u, payload, digest, r), level, mtime=0)
                    sink.write(member)
                    rows.append((p, u, name, at, len(member), len(payload), digest, "response" if r is None else "revisit"))
                    at += len(member)
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                names = [x.split()[0] for x in INDEX.split(", ")]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        finally:
            if sink:
                sink.close()

    long_id = pages.select(F.col("page_id").cast("long"), "url", "html", F.col("refers_to").cast("long"))
    return long_id.mapInArrow(over_batches(work), INDEX)


def read_records(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 8 << 20, stripe: int = 64 << 20) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, html of the index rows given, from the archives.

    Rows are dealt out by file and stripe and sorted by offset; ranges at most `gap` bytes apart share a read of at
    most `most` bytes (a larger record is read alone). The payload's digest is checked against the index; one that
    differs is a ValueError. Each index row gives a row, repeated ones too; html is null for revisits; no rows give none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        source, opened = None, None
        try:
            for batch in batches:
                todo = list(zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True))
                rows, at = [], 0
                while at < len(todo):
                    name, begin, end, last = todo[at][0], todo[at][1], todo[at][1] + todo[at][2], at + 1
                    while last < len(todo) and todo[last][0] == name and 0 <= todo[last][1] - end <= gap and todo[last][1] + todo[last][2] - begin <= most:
                        end, last = todo[last][1] + todo[last][2], last + 1
                    if opened != name:
                        if source:
                            source.close()
                        source, opened = store.open_input_file(f"{root}/{name}"), name
                    data = source.read_at(end - begin, begin)
                    for _, offset, length, page, digest in todo[at:last]:
                        rows.append((page, *_read(data[offset - begin : offset - begin + length], digest)))
                    at = last
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(RECORDS))
        finally:
            if source:
                source.close()

    stripes = F.floor(F.col("offset") / stripe)
    dealt = index.select("file", "offset", "length", "page_id", "payload_digest").repartition("file", stripes)
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(over_batches(work), ", ".join(f"{k} {v}" for k, v in RECORDS.items()))


RECORDS = {"page_id": "long", "url": "string", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "html": "string"}


def _read(member: bytes, digest: str) -> tuple:
    with gzip.GzipFile(fileobj=io.BytesIO(member)) as unpacked:
        fields, http, payload = parse(unpacked.read())
    kind = fields["WARC-Type"]
    if fields["WARC-Payload-Digest"] != f"sha1:{digest}" or kind == "response" and digest_of(payload) != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't match its index row")
    refers = _page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
    html = payload.decode("utf-8") if kind == "response" else None
    return fields.get("WARC-Target-URI"), int(http["Content-Length"]), digest, kind, refers, html


def op4_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the archives.

    A null html is an empty payload. Of equal payloads the largest page_id is the response; rows that share it, and
    rows without a page_id, are responses each. Repeated rows stay, an empty table gives no rows, other columns are not
    looked at. The archives stay in the shared folder, as rows are read from them when the result is.
    """
    folder = fresh_path(spark, "warc")
    pages = with_originals(table(spark, sf_dir, "pages"))
    index, _ = stored(write_archives(pages, folder), "warc-index")
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH full_text AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex,
    max(page_id) OVER (PARTITION BY sha1(body)) AS last FROM full_text
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS BIGINT) >> CAST(5 * (3 - k % 4) AS INT)) & 31) AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM digests
"""
