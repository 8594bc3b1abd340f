"""WARC (operator 4): archives of page captures, written and read back, and assembled into transactions.

Each page becomes three records: request, response or revisit, and metadata (with its page_id); request and metadata name the response in
WARC-Concurrent-To. Of equal payloads of `least` bytes or more the smallest page_id (then the first place in the input) is a response, the others
are revisits that name it in WARC-Refers-To. Spark's text writer puts the records into gzip files of about FILE_BYTES and at most PER_FILE captures (by the mean size of this input's captures); records end
with two line breaks, which is the writer's line separator. A lost task's file is written again under Spark's commit protocol.

The reader takes files of any number of gzip members, or plain ones. It inflates them piece by piece, so it holds a compressed file and one record, walks the records by Content-Length and checks each response's payload against its
digest; rows go on in batches of about BATCH_BYTES. Assembly groups all records by the identifier that they name (a response by its own), which joins the three kinds in one
shuffle, and gives one nested row a capture; a request or metadata record without a response stays as a row without one.

Null html is an empty payload, a null url an empty target; line breaks in a url are dropped. Repeated rows are captures of their own.
A null page_id comes first among equal payloads. Very long pages are records like others. Columns but page_id, url and html are not read. An empty table gives no rows."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import common

LEAST, PER_FILE, FILE_BYTES, BREAK, DATE = 100, 2000, 64 << 20, "\r\n", "2024-01-01T00:00:00Z"
RECORD = "record_id string, kind string, names string, target_uri string, refers_to string, payload_digest string, payload_bytes long, fields string, payload binary"


def _id(kind: str) -> Column:
    h = F.md5(F.concat_ws("/", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.col("uid").cast("string"), F.lit(kind)))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: Column | str, record_id: Column, mime: str, block: Column, *more: tuple[str, Column]) -> Column:
    """A record without the two line breaks at its end. Headers whose value is null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)), *more, ("Content-Type", F.lit(mime)), ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.lit("WARC/1.1"), *(F.concat(F.lit(f"{k}: "), v) for k, v in head)]
    return F.concat(F.concat_ws(BREAK, *lines), F.lit(2 * BREAK), block)


def write(pages: DataFrame, folder: str, *, least: int = LEAST, per_file: int = PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """pages (page_id, url, html) to archives in `folder`."""
    rows = common.with_uid(pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html")))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    seen = Observation()
    size = rows.select("page_id", "uid", "digest", F.octet_length("html").alias("size")).observe(seen, F.avg("size").alias("mean"))
    keys = size.filter(F.col("size") >= least).select("page_id", "uid", "digest")
    firsts = keys.groupBy("digest").agg(F.min(F.struct("page_id", "uid")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    again = common.cut(keys.join(common.cut(firsts), "digest").filter("uid != first.uid").select("uid", F.struct(F.col("first.page_id"), F.col("first.uid")).alias("first")))
    per_file = max(1, min(per_file, int(file_bytes / ((seen.get["mean"] or 0) + 1000))))  # 1000 for headers
    rows = rows.join(again, "uid", "left")
    own, uri = _id("response"), ("WARC-Target-URI", F.when(F.col("url") != "", F.col("url")))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.octet_length("html").cast("string"), F.lit(2 * BREAK))
    first_id = F.when(F.col("first").isNotNull(), F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("/", F.coalesce(F.col("first.page_id").cast("string"), F.lit("-")), F.col("first.uid").cast("string"), F.lit("response"))), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">")))
    path = F.regexp_extract("url", "^[^:/?#]+://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract("url", "^[^:/?#]+://([^/?#]*)", 1)
    request = _record("request", _id("request"), "application/http; msgtype=request", F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{BREAK}Host: "), host, F.lit(2 * BREAK)), uri, ("WARC-Concurrent-To", own))
    is_new = F.col("first").isNull()
    answer = _record(
        F.when(is_new, "response").otherwise("revisit"), own, "application/http; msgtype=response", F.concat(answer, F.when(is_new, F.col("html")).otherwise("")), uri,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), ("WARC-Refers-To", first_id), ("WARC-Profile", F.when(~is_new, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
    )
    metadata = _record("metadata", _id("metadata"), "application/warc-fields", F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(BREAK)), uri, ("WARC-Concurrent-To", own))
    capture = F.concat_ws(2 * BREAK, request, answer, metadata).alias("value")
    rows.select(capture).write.option("lineSep", 2 * BREAK).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(folder)


def _inflated(data: memoryview) -> Iterator[bytes]:
    """The bytes of a file of one gzip member or more, or of a plain one, in pieces of about BATCH_BYTES at most."""
    if bytes(data[:2]) != b"\x1f\x8b":
        for a in range(0, len(data), common.BATCH_BYTES):
            yield bytes(data[a : a + common.BATCH_BYTES])
        return
    member, rest, a, begun = zlib.decompressobj(31), b"", 0, False
    while rest or a < len(data):
        if not rest:
            rest = bytes(data[a : a + (1 << 18)])
            a += len(rest)
        if not begun and not (rest := rest.lstrip(b"\0")):  # padding between members
            continue
        begun = True
        out = member.decompress(rest, common.BATCH_BYTES)
        rest = member.unconsumed_tail
        if out:
            yield out
        if member.eof:
            member, rest, begun = zlib.decompressobj(31), member.unused_data, False
    if begun:
        raise ValueError("a gzip member is cut short")


class _Input:
    """Bytes of an iterator, as many as are asked for."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held, self.at = pieces, bytearray(), 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        del self.held[: self.at]
        self.at = 0
        self.held += piece
        return True

    def past(self, mark: bytes) -> bytes | None:
        """Up to the mark, without it; None at the end."""
        seen = 0
        while (found := self.held.find(mark, self.at + seen)) < 0:
            seen = max(0, len(self.held) - self.at - len(mark) + 1)
            if not self.more():
                if len(self.held) > self.at:
                    raise ValueError("a record is cut short")
                return None
        out = bytes(self.held[self.at : found])
        self.at = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            if not self.more():
                raise ValueError("a record is cut short")
        out = bytes(self.held[self.at : self.at + n])
        self.at += n
        return out


def records(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    source = _Input(_inflated(memoryview(data)))
    while (top := source.past(b"\r\n\r\n")) is not None:
        lines = top.decode().split(BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = source.take(int(head["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"{head.get('warc-record-id')}: its length is not that of its block")
        yield head, block


def _parse(with_payload: bool):  # noqa: ANN202
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 9, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in common.column(batch, "content"):
                rows, size = [], 0
                for head, block in records(content.as_buffer()):
                    kind, payload, fields = head["warc-type"], None, None
                    digest = head.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if digest is not None and digest != hashlib.sha256(payload).hexdigest():
                            raise ValueError(f"{head['warc-record-id']}: the payload doesn't have its digest")
                    elif kind != "revisit":
                        fields = block.decode(errors="replace")
                    rows.append((head["warc-record-id"], kind, head.get("warc-concurrent-to"), head.get("warc-target-uri", ""), head.get("warc-refers-to"), digest, None if payload is None else len(payload), fields, payload if with_payload else None))
                    size += len(block)
                    if size > common.BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    return run


def read(spark: SparkSession, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records of all archives in a folder."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.transform(common.mapped, _parse(with_payload), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: capture_id, request, response (or revisit), metadata."""
    part = lambda kinds, *fields: F.max(F.when(F.col("kind").isin(*kinds), F.struct(*fields)))
    return records.groupBy(F.coalesce("names", "record_id").alias("capture_id")).agg(
        part(["request"], "record_id", "target_uri", "fields").alias("request"),
        part(["response", "revisit"], "record_id", "kind", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload").alias("response"),
        part(["metadata"], "record_id", "fields").alias("metadata"),
    )


def new_folder(spark: SparkSession) -> str:
    return f"{common.shared_dir(spark)}/warc-{uuid.uuid4().hex}"
