"""WARC archives written and read by Spark, with segmented records.

Writing: one record per page; payloads are framed as chunked HTTP responses and
records longer than a segment are cut into continuation records. Reading: the
archives' records are parsed as a stream, continuations are grouped by the
origin's identifier, ordered by segment number and checked against the total
length, and the chunked framing is decoded.

Archives are files of Spark's text writer: its line separator is the blank
line that ends every WARC record, so the commit protocol, retries and every
file system that Spark knows are covered. Whole-file gzip keeps one archive in
one task, in order.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = b"\r\n"
END = "\r\n\r\n"
#: Bytes of a record's block in one segment, and of one chunk of the HTTP framing.
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
#: Payloads shorter than this are never stored as revisits.
REVISIT_LEAST = 100

_RECORD = ("record_id string, type string, page_id long, url string, origin string, "
           "segment int, total long, refers_to long, digest string, block binary")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP/1.1 chunked transfer framing of ``payload``."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out += (b"%x" % len(part), CRLF, part, CRLF)
    return b"".join(out) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body; chunk extensions and trailers are skipped.
    Raises ValueError on broken framing."""
    out, at = [], 0
    while True:
        stop = body.find(CRLF, at)
        if stop < 0:
            raise ValueError("chunk size line is missing")
        size = int(body[at:stop].split(b";")[0].strip(), 16)
        at = stop + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != CRLF:
            raise ValueError("chunk is shorter than its size line says")
        out.append(body[at:at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None),
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def _clean(value: str | None) -> str | None:
    """A header value on one line."""
    return None if value is None else re.sub(r"[\r\n]+", " ", value)


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, row: str, segment_bytes: int = SEGMENT_BYTES,
                 chunk_bytes: int = CHUNK_BYTES) -> list[bytes]:
    """The WARC records of one page, first segment first."""
    revisit = refers_to is not None
    if revisit:
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes))
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row)}>"
    shared = [("WARC-Target-URI", _clean(url)), ("X-Page-Id", page_id),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Refers-To-Page-Id", refers_to)]
    out = []
    for i, part in enumerate(parts, 1):
        ident = first if i == 1 else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row}#{i}')}>"
        kind = "continuation" if i > 1 else "revisit" if revisit else "response"
        own = [("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", "1970-01-01T00:00:00Z")]
        if len(parts) > 1:
            own += [("WARC-Segment-Number", i), ("WARC-Segment-Origin-ID", first if i > 1 else None),
                    ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None)]
        out.append(_record(own + shared if i == 1 else own, part))
    return out


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
               chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives below ``path``.

    A null html is an empty payload, null ids and urls are left out of the
    headers. Of records with equal payloads of at least ``REVISIT_LEAST`` bytes
    those with the smallest page_id are responses (equal ids cannot be told
    apart), all others revisit it; null ids count as largest. Only ids and
    digests are compared across tasks; payloads move once, keyed by row.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    ids = rows.where(F.octet_length("html") >= REVISIT_LEAST).select("page_id", "digest")
    first = (ids.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where((F.col("n") > 1) & F.col("first").isNotNull()).drop("n"))
    later = (ids.join(first, "digest")
             .where(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
             .select(F.col("page_id").alias("later_id"), F.col("digest").alias("later_digest"),
                     F.col("first").alias("refers_to")).distinct())
    told = rows.join(later.hint("shuffle_hash"),
                     F.col("page_id").eqNullSafe(F.col("later_id"))
                     & (F.col("digest") == F.col("later_digest")), "left") \
        .select("page_id", "url", "html", "digest", "refers_to",
                F.concat_ws(":", F.spark_partition_id(), F.monotonically_increasing_id()).alias("row"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for at in range(0, len(cols[0]), 256):
                out = [r for page, url, html, digest, refers, row in zip(*(c[at:at + 256] for c in cols))
                       for r in page_records(page, url, html.encode(), digest, refers, row,
                                             segment_bytes, chunk_bytes)]
                yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    (told.mapInArrow(build, "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", END).option("compression", "gzip").text(path))


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _parsed(fields: dict[str, str], block: bytes) -> dict:
    number = lambda k: int(fields[k]) if k in fields else None
    return {"record_id": fields.get("warc-record-id"), "type": fields.get("warc-type"),
            "page_id": number("x-page-id"), "url": fields.get("warc-target-uri"),
            "origin": fields.get("warc-segment-origin-id"),
            "segment": number("warc-segment-number"),
            "total": number("warc-segment-total-length"),
            "refers_to": number("x-refers-to-page-id"),
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            "block": block}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, continuations apart. The
    pieces between separators restore the stream of bytes, in which a record is
    read by its Content-Length, so blank lines in a block do no harm.
    Raises ValueError when an archive ends inside a record."""
    lines = (spark.read.option("lineSep", END).text(path)
             .select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file")))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RECORD.split(", ")]
        types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        schema = pa.schema([(n, types[x.split()[1]]) for n, x in zip(names, _RECORD.split(", "))])
        file, fields, stream = None, None, bytearray()
        for batch in batches:
            out = []
            for piece, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    if fields is not None or stream.strip():
                        raise ValueError(f"{file} ends inside a record")
                    file, stream = name, bytearray()
                stream += piece
                stream += END.encode()  # the separator stood between pieces
                while True:
                    if fields is None:
                        begin = len(stream) - len(stream.lstrip(CRLF))
                        stop = stream.find(END.encode(), begin)
                        if stop < 0:
                            break
                        fields = _fields(bytes(stream[begin:stop]))
                        del stream[:stop + 4]
                    size = int(fields["content-length"])
                    if len(stream) < size + 4:
                        break
                    if stream[size:size + 4] != END.encode():
                        raise ValueError(f"{file}: a record is longer than its Content-Length")
                    out.append(_parsed(fields, bytes(stream[:size])))
                    del stream[:size + 4]
                    fields = None
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if fields is not None or stream.strip():
            raise ValueError(f"{file} ends inside a record")

    return lines.mapInArrow(parse, _RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records of ``records``: segments are grouped by the identifier of
    the record they continue, joined in the order of their numbers and checked.
    ``block`` is null and ``problem`` says why when a segment is missing or
    doubled or the total length differs. Only segmented records are shuffled;
    a group holds one record."""
    plain = F.coalesce("segment", F.lit(0)) == 0
    whole = records.where(plain).withColumn("problem", F.lit(None).cast("string"))
    parts = records.where(~plain).withColumn("key", F.coalesce("origin", "record_id"))
    grouped = parts.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.max_by(c, -F.col("segment")).alias(c)
          for c in ("record_id", "type", "page_id", "url", "refers_to", "digest")])
    block = F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["block"]))
    numbers = F.transform("parts", lambda x: x["segment"])
    problem = (F.when(numbers != F.sequence(F.lit(1), F.size("parts")), "a segment is missing or doubled")
               .when(F.col("total").isNull(), "the last segment is missing")
               .when(F.octet_length(block) != F.col("total"), "the total length differs"))
    joined = grouped.withColumn("problem", problem).withColumn(
        "block", F.when(F.col("problem").isNull(), block)) \
        .withColumns({"origin": F.lit(None).cast("string"), "segment": F.lit(None).cast("int")})
    return whole.unionByName(joined.select(*whole.columns))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives below ``path``: page_id, url, record_type,
    refers_to, payload (null for revisits), payload_bytes, payload_digest and
    problem (null, or why a record could not be put together; its other result
    columns are then null)."""
    schema = ("page_id long, url string, record_type string, refers_to long, payload binary, "
              "payload_bytes long, payload_digest string, problem string")
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(n, types[x.split()[1]]) for n, x in zip(names, schema.split(", "))])

    def one(r: dict) -> dict:
        out = {"page_id": r["page_id"], "url": r["url"], "record_type": r["type"],
               "refers_to": r["refers_to"], "payload": None, "payload_bytes": None,
               "payload_digest": None, "problem": r["problem"]}
        if r["block"] is None:
            return out
        head, _, body = r["block"].partition(END.encode())
        http = _fields(head)
        if r["type"] == "revisit":
            return out | {"payload_bytes": int(http["content-length"]), "payload_digest": r["digest"]}
        try:
            payload = dechunked(body) if http.get("transfer-encoding") == "chunked" else body
        except ValueError as e:
            return out | {"problem": str(e)}
        digest = hashlib.sha256(payload).hexdigest()
        if r["digest"] not in (None, digest):
            return out | {"problem": "the payload digest differs"}
        return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([one(r) for r in batch.slice(at, 256).to_pylist()], fields)

    return (reassemble(read_records(spark, path))
            .select("page_id", "url", "type", "refers_to", "digest", "block", "problem")
            .mapInArrow(decode, schema))
