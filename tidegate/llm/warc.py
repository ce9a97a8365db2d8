"""WARC archives: segmented writing, and reassembly on reading.

Writing: one record per page.  Of pages with equal payloads the one with the largest id is a response, the others revisit
it and have no payload.  A response is an HTTP message with a chunked body; if its block is longer than ``segment`` bytes it goes on in
continuation records.  Spark's text writer puts the records into gzip files of at most ``records`` records, so no archive has more than
about ``segment * records`` bytes, however long a page is.

Reading: each archive is parsed by the lengths its records state.  Continuations meet their first segment by its identifier,
are ordered by number and checked for gaps and total length, then the chunked framing is taken off and the payload's digest checked.  A revisit
takes its payload's length from the response it refers to.

Cases: a null payload is empty, a null url is written as an empty target.  Null ids are smaller than all others, and come back
as null.  Rows that repeat an id and a payload are all responses, or all revisits, as the id says.  No rows give archives without
records.  Other columns are not read.  A record that breaks a check raises an error: nothing is left out in silence.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import join_groups, slices, stored
from tidegate.storage import scratch_folder

CRLF = b"\r\n"
CHUNK = 8192
DATE = "2000-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space of URLs
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD = "record_id string, type string, origin string, segment int, total long, page_id long, digest string, refers_to string, block binary"
PAGE = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def chunked(payload: bytes) -> bytes:
    parts = [payload[k : k + CHUNK] for k in range(0, len(payload), CHUNK)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body.  Extensions of chunks and trailing headers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk does not end where its length says")
        parts.append(body[at : at + size])
        at += size + 2


def record(headers: dict[str, object], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        first, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record where the one before ends")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        at = start + int(headers["content-length"])
        if data[at : at + 4] != CRLF + CRLF:
            raise ValueError("a record does not end where its length says")
        yield headers, data[start:at]
        at += 4


def response_id(page_id: int | None, digest: str) -> str:
    """The identifier others refer to: it follows from the page and its payload."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}/{digest}')}>"


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, origin: int | None, segment: int) -> Iterator[bytes]:
    target = "".join((url or "").split())
    common = {"WARC-Date": DATE, "WARC-Target-URI": target, "X-Page-Id": page_id, "WARC-Payload-Digest": f"sha1:{digest}"}
    if page_id != origin:
        own = {"WARC-Type": "revisit", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "X-Refers-To-Page": origin}
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record(own | common | {"WARC-Profile": profile, "WARC-Refers-To": response_id(origin, digest)}, b"")
        return
    block = HTTP + chunked(payload)
    # Rows that repeat an id and a payload need identifiers of their own to be put together by.
    name = f"<urn:uuid:{uuid.uuid4()}>"
    parts = [block[k : k + segment] for k in range(0, len(block), segment)]
    number = {"WARC-Segment-Number": 1} if len(parts) > 1 else {}
    own = {"WARC-Type": "response", "WARC-Record-ID": name, "X-Response-Id": response_id(page_id, digest)}
    yield record(own | common | number, parts[0])
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        own = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE}
        yield record(own | {"WARC-Segment-Origin-ID": name, "WARC-Segment-Number": k, "WARC-Segment-Total-Length": total}, part)


def write(pages: DataFrame, path: str, segment: int = 65536, records: int = 512) -> None:
    """Write ``page_id, url, html`` as archives into the folder ``path``."""
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    groups = stored(rows.groupBy("sha1").agg(F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("n")), "payloads")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "payload"):
            out = []
            for row in part.to_pylist():
                digest = digest_text(row["sha1"])
                out.extend(page_records(row["page_id"], row["url"], row["payload"], digest, row["origin"], segment))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    written = join_groups(rows, groups, ["sha1"], "n", "inner").mapInArrow(run, "record binary")
    # A record is followed by two line ends, which is what the writer puts between its rows.
    written.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", records
    ).text(path, compression="gzip")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, plain or in gzip files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kinds = [types[c.split()[1]] for c in RECORD.split(", ")]
        for batch in batches:
            for data in batch.column("content"):
                data = data.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = []
                for h, block in parse(data):
                    number = {k: int(h[k]) if k in h else None for k in ("warc-segment-number", "warc-segment-total-length", "x-page-id")}
                    rows.append(
                        (h["warc-record-id"] if h["warc-type"] != "response" else h.get("x-response-id", h["warc-record-id"]), h["warc-type"],
                         h.get("warc-segment-origin-id", h["warc-record-id"]), number["warc-segment-number"], number["warc-segment-total-length"],
                         number["x-page-id"], h.get("warc-payload-digest", "").removeprefix("sha1:"), h.get("warc-refers-to"), block)
                    )
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The pages of the archives: ``PAGE``, revisits without a payload of their own."""
    records = read_records(spark, path).where("type in ('response', 'revisit', 'continuation')")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["type"] == "revisit":
                    rows.append((r["record_id"], r["page_id"], None, r["digest"], "revisit", r["refers_to"], None))
                    continue
                parts = sorted(r["parts"], key=lambda p: p["segment"])
                block = b"".join(p["block"] for p in parts)
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or (len(parts) > 1 and parts[-1]["total"] != len(block)):
                    raise ValueError(f"segments of {r['origin']} are missing")
                head, _, body = block.partition(CRLF + CRLF)
                payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                digest = digest_text(hashlib.sha1(payload).digest())
                if r["digest"] and digest != r["digest"]:
                    raise ValueError(f"the payload of {r['origin']} is not what was written")
                rows.append((r["record_id"], r["page_id"], len(payload), digest, "response", None, payload))
            names = [c.split()[0] for c in PAGE.split(", ")]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "total", "block")
    split = F.col("segment").isNotNull()
    head = ["record_id", "type", "origin", "page_id", "digest", "refers_to"]
    alone = records.where(~split).select(*head, F.array(part).alias("parts"))
    first = [F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c) for c in head if c != "origin"]
    joined = records.where(split).groupBy("origin").agg(*first, F.collect_list(part).alias("parts")).select(*head, "parts")
    return alone.unionByName(joined).mapInArrow(whole, PAGE)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    spark = pages.sparkSession
    path = scratch_folder(spark, "llm-warc")
    write(pages, path)
    found = stored(read(spark, path).drop("payload"), "warc-pages")
    # One row per payload: rows that repeat an id and a payload have one identifier.
    names = found.where("record_type = 'response'").groupBy("record_id").agg(
        F.max("page_id").alias("response_page"), F.max("payload_bytes").alias("response_bytes")
    )
    sizes = found.where("record_type = 'revisit'").groupBy(F.col("refers_to").alias("record_id")).agg(F.count(F.lit(1)).alias("n"))
    targets = stored(names.join(sizes, "record_id").withColumnRenamed("record_id", "refers_to"), "warc-targets")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = join_groups(found.where("record_type = 'revisit'").select(*columns), targets, ["refers_to"], "n")
    revisits = revisits.select("page_id", F.col("response_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("response_page").alias("refers_to"))
    responses = found.where("record_type = 'response'").select(*columns[:4], F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
