"""WARC archives as a chunked record table (operator 9).

An archive is written and read by Spark's own text reader and writer, so it can lie in any store
that Spark reaches.  One row is one WARC record; the blank lines that end a record are the writer's
line separator, and the reader cuts before the next version line.  A payload larger than ``segment``
bytes becomes a chain of records (segment 1 and its continuations), and no segment holds the
version line, so cutting is exact whatever a payload contains.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import pin, scratch_path

SEGMENT = 1 << 20
BROADCAST_DIGESTS = 500_000  # digests of repeated payloads that may be broadcast (about 30 MB)

# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_END = "\r\n\r\n"
NEXT_RECORD = "\r\n\r\nWARC/1.1\r\n"

_RECORD = "page_id long, url string, segment int, last boolean, type string, digest string, refers_to long, n_bytes long, data binary"


def digest_of(*chunks: bytes | memoryview) -> str:
    sha = hashlib.sha1()
    for chunk in chunks:
        sha.update(chunk)
    return base64.b32encode(sha.digest()).decode()


def cuts(payload: memoryview, segment: int) -> list[tuple[int, int]]:
    """Pieces of at most ``segment`` bytes; one more cut falls into each version line."""
    edges = sorted({*range(segment, len(payload), segment), *(m.start() + 2 for m in re.finditer(VERSION, payload))})
    return list(zip([0, *edges], [*edges, len(payload)]))


def _digests(html: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for cell in batch.column(html).cast(pa.binary()):
                payload = memoryview(cell.as_buffer()) if cell.is_valid else memoryview(b"")
                sizes.append(len(payload))
                digests.append(digest_of(payload))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                [*batch.schema.names, "payload_bytes", "payload_digest"])

    return step


def _uri(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}>"


def _header(**fields: str | int | None) -> bytes:
    lines = [f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items() if v is not None]
    return VERSION + b"\r\n" + "".join(lines).encode() + b"\r\n"


def _records(segment: int, date: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["page_id", "url", "payload_digest", "refers_to", "revisit"]).to_pylist()
            out: list[bytes] = []
            size = 0
            for row, cell in zip(rows, batch.column("html").cast(pa.binary())):
                payload = memoryview(cell.as_buffer()) if cell.is_valid else memoryview(b"")
                pieces = [(0, 0)] if row["revisit"] else cuts(payload, segment)
                name = _uri(row["page_id"], row["payload_digest"])
                for k, (a, b) in enumerate(pieces, 1):
                    many, last = len(pieces) > 1, k == len(pieces)
                    block = HTTP if k == 1 else b""
                    head = _header(
                        WARC_Type="continuation" if k > 1 else "revisit" if row["revisit"] else "response",
                        WARC_Record_ID=name if k == 1 else name[:-1] + f":{k}>",
                        WARC_Date=date,
                        WARC_Target_URI=None if row["url"] is None else re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", row["url"]),
                        WARC_Payload_Digest="sha1:" + row["payload_digest"] if k == 1 else None,
                        WARC_Refers_To=_uri(row["refers_to"], row["payload_digest"]) if row["revisit"] else None,
                        WARC_Profile=PROFILE if row["revisit"] else None,
                        WARC_Segment_Number=k if many else None,
                        WARC_Segment_Origin_ID=name if k > 1 else None,
                        WARC_Segment_Total_Length=len(HTTP) + len(payload) if many and last else None,
                        Content_Type="application/http;msgtype=response" if k == 1 else None,
                        Content_Length=len(block) + b - a,
                    )
                    out.append(b"".join((head, block, payload[a:b])))
                    size += len(out[-1])
                    if size > 8 * SEGMENT:  # so that a batch stays small beside one payload
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return step


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with payload_bytes, payload_digest, revisit and refers_to.

    Of equal payloads of at least ``least_bytes`` bytes, those with the least page_id are responses;
    the others revisit it.  Digests are counted with map-side sums; only those that occur more than
    once go back to the pages, broadcast if their number, counted first, allows it.
    """
    plain = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"))
    hashed = plain.mapInArrow(_digests(2), "page_id long, url string, html binary, payload_bytes long, payload_digest string")
    repeated = pin(
        plain.select("page_id", "html").mapInArrow(_digests(1), "page_id long, html binary, payload_bytes long, payload_digest string")
        .where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    revisit = F.coalesce(F.col("refers_to").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))), F.lit(False))
    return hashed.join(repeated, "payload_digest", "left").withColumn("revisit", revisit).withColumn(
        "refers_to", F.when(F.col("revisit"), F.col("refers_to")))


def write_warc(
    pages: DataFrame, path: str, least_bytes: int = 0, segment: int = SEGMENT, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write one record (or chain of segments) per row of ``pages`` (page_id, url, html) to ``path``.

    Each task writes files of its own rows; payloads are not shuffled unless the repeated digests are
    too many to broadcast.  A null html is an empty payload, a null url leaves the field out.
    """
    rows = with_record_types(pages, least_bytes).select("page_id", "url", "html", "payload_digest", "refers_to", "revisit")
    records = rows.mapInArrow(_records(segment, date), "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", RECORD_END).text(path)


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse(record: bytes) -> dict:
    """Fields and block of one row of the reader."""
    end = record.index(b"\r\n\r\n") + 4
    fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(record, 0, end - 2)}
    block = memoryview(record)[end : end + int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
    if fields["warc-type"] != "continuation":
        block = block[bytes(block[: len(HTTP) + 4096]).index(b"\r\n\r\n") + 4 :]
    return {"fields": fields, "payload": block}


def _page_of(uri: str) -> tuple[int | None, str]:
    page, digest = uri.strip("<>").split(":")[2:4]
    return (None if page == "none" else int(page)), digest


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records to rows; a payload of one segment is reduced to its length and digest at once."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("segment", pa.int32()), ("last", pa.bool_()), ("type", pa.string()),
        ("digest", pa.string()), ("refers_to", pa.int64()), ("n_bytes", pa.int64()), ("data", pa.binary())])
    for batch in batches:
        out = []
        for record in batch.column(0).to_pylist():
            if not record.strip(b"\r\n"):
                continue
            got = parse(record)
            fields, payload = got["fields"], got["payload"]
            kind = fields["warc-type"]
            page_id, digest = _page_of(fields.get("warc-segment-origin-id") or fields["warc-record-id"])
            number = int(fields.get("warc-segment-number", 1))
            last = "warc-segment-number" not in fields or "warc-segment-total-length" in fields
            whole = kind == "response" and number == 1 and last
            if whole and digest_of(payload) != digest:
                raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
            out.append({
                "page_id": page_id, "url": fields.get("warc-target-uri"), "segment": number, "last": last, "type": kind,
                "digest": digest, "refers_to": _page_of(fields["warc-refers-to"])[0] if kind == "revisit" else None,
                "n_bytes": len(payload) if whole else None,
                "data": None if whole or kind == "revisit" else bytes(payload)})
        yield pa.RecordBatch.from_pylist(out, schema)


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record from rows in (page, digest, segment) order.

    The digest of a chain is carried from segment to segment; its payload is never put together.
    Rows repeated in the pages have equal chains, of which one is read.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64())])
    key, heads, sha, size, at = None, [], None, 0, 0

    def done() -> list[dict]:
        if sha is not None and heads:
            if base64.b32encode(sha.digest()).decode() != key[1]:
                raise ValueError(f"segments of page {key[0]} do not match their digest")
            for head in heads:
                head["payload_bytes"] = size if head["payload_bytes"] is None and head["record_type"] == "response" else head["payload_bytes"]
        return heads

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["page_id"], row["digest"]) != key:
                out += done()
                key, heads, sha, size, at = (row["page_id"], row["digest"]), [], None, 0, 0
            if row["type"] != "continuation":
                heads.append({
                    "page_id": row["page_id"], "url": row["url"], "payload_digest": row["digest"],
                    "record_type": row["type"], "refers_to": row["refers_to"], "payload_bytes": row["n_bytes"]})
            if row["data"] is not None and row["segment"] > at:
                if row["segment"] != at + 1:
                    raise ValueError(f"a segment of page {key[0]} is missing")
                sha = sha or hashlib.sha1()
                sha.update(row["data"])
                size, at = size + len(row["data"]), row["segment"]
        yield pa.RecordBatch.from_pylist(out, schema)
    yield pa.RecordBatch.from_pylist(done(), schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record chain.

    Length and digest are taken of the payloads as read and checked against the header; a revisit
    has those of the response that it names.  Only segments of oversized payloads are shuffled.
    """
    text = spark.read.option("lineSep", NEXT_RECORD).text(path)
    rows = text.select(F.col("value").cast("binary")).mapInArrow(_read, _RECORD)
    order = ["page_id", "digest", "segment"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chains = rows.repartition(n, "page_id", "digest").sortWithinPartitions(*order).mapInArrow(
        _join_segments,
        "page_id long, url string, payload_digest string, record_type string, refers_to long, payload_bytes long")
    chains = pin(chains)
    sizes = chains.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("_size"))
    revisits = chains.where("record_type = 'revisit'").join(sizes, "payload_digest", "left").withColumn("payload_bytes", F.col("_size"))
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return chains.where("record_type = 'response'").select(columns).unionByName(revisits.select(columns))


def warc_round_trip(pages: DataFrame, path: str | None = None, least_bytes: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Write ``pages`` as archives and read them back; ``path`` defaults to a fresh shared folder."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(pages, path, least_bytes, segment)
    return read_warc(spark, path)
