"""WARC archives: written with segmented records and chunked framing, read back by reassembly.

Writing goes through Spark's text sink with ``\\n`` as separator and gzip: a record is ASCII headers
and UTF-8 payload, and ends in ``\\n``, so a file's content is exactly its records one after another.
Reading takes the lines of a file in order (gzip files are not split) and cuts records by their
Content-Length, so memory holds one record at a time. A block longer than ``segment`` bytes is
cut into a first record and continuation records. Readers hand those to a group per origin
identifier, which orders them by segment number and checks numbers and total length; then the chunked transfer framing
is decoded and the payload's digest is held against the header's.
"""

from __future__ import annotations

import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.llm.shared import text_bytes
from catalog_sync.scratch import scratch_dir, stage

SEGMENT = 1 << 16
CHUNK = 1 << 14
DATE = "1970-01-01T00:00:00Z"
HTTP = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
)


def digest(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def cuts(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in parts of at most ``size`` bytes (from 4) that begin at code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    framed = [b"%x\r\n%b\r\n" % (len(c), c) for c in cuts(payload, size)]
    return b"".join(framed) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        chunk = body[end + 2 : end + 2 + size]
        if len(chunk) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        out.append(chunk)
        at = end + 4 + size


def record(kind: str, name: str, block: bytes, **more) -> bytes:
    """One WARC record; ``more``: further headers, those of None are left out."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": DATE}
    head |= {k.replace("_", "-"): v for k, v in more.items() if v is not None}
    head["Content-Length"] = len(block)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_records(page, url: str | None, html: bytes, refers_to, n: int, segment: int) -> Iterator[bytes]:
    name = f"urn:page:{'' if page is None else page}:{n}"
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")
    common = {"WARC_Target_URI": uri, "WARC_Payload_Digest": f"sha1:{digest(html)}", "X_Page_ID": page}
    if refers_to is not None:
        yield record(
            "revisit", name, b"", **common, WARC_Refers_To=f"<urn:page:{refers_to}>",
            WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        )
        return
    block = HTTP + chunked(html)
    parts = list(cuts(block, segment))
    common["Content_Type"] = "application/http; msgtype=response"
    for i, part in enumerate(parts, 1):
        last = {"WARC_Segment_Total_Length": len(block)} if i == len(parts) > 1 else {}
        if i == 1:
            yield record("response", name, part, **common, WARC_Segment_Number=1 if len(parts) > 1 else None)
        else:
            yield record("continuation", f"{name}:{i}", part, WARC_Segment_Origin_ID=f"<{name}>",
                         WARC_Segment_Number=i, **last)


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, segment: int = SEGMENT,
) -> None:
    """A record per row of ``pages`` under ``path``: response, or revisit of an equal payload.

    Of the rows with equal payloads of ``min_bytes`` or more (NULL html is the empty payload) that
    with the smallest key is the response, or all that repeat this key; a row without key is a
    revisit where an equal payload has one. A NULL url is written as ``about:blank``. Other columns are not read.
    """
    rows = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"), text_bytes(html).alias("__html"))
    prints = stage(
        rows.select("__key", F.sha1("__html").alias("__sha"), F.octet_length("__html").alias("__size")),
        "digests",
    )
    first = (
        prints.where(F.col("__size") >= min_bytes).groupBy("__sha")
        .agg(F.min("__key").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1 AND __first IS NOT NULL").select("__sha", "__first")
    )
    again = (
        prints.join(stage(first, "firsts"), "__sha").where("__key IS NULL OR __key <> __first")
        .select(F.col("__key").alias("__k"), F.col("__sha").alias("__s"), "__first").distinct()
    )
    again = stage(again, "again")  # its size is known then: Spark broadcasts it only if it is small
    match = F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__sha") == F.col("__s"))
    joined = (
        rows.withColumn("__sha", F.sha1("__html")).withColumn("__turn", F.monotonically_increasing_id())
        .join(again, match, "left").select("__key", "__url", "__html", "__first", "__turn")
    )

    def build(batches):
        for batch in batches:
            values = [batch.column(i).to_pylist() for i in range(5)]
            records = (r for row in zip(*values, strict=True) for r in page_records(*row, segment))
            # The sink adds the last \n of each record.
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[:-1] for r in records], pa.binary()).cast(pa.string())], names=["value"]
            )

    joined.mapInArrow(build, "value string").write.option("lineSep", "\n").option(
        "compression", "gzip"
    ).text(path)


def records(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records in ``lines``, each given without its ``\\n``."""
    for line in lines:
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        for line in lines:
            if line == b"\r":
                break
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        need = int(head["content-length"]) + 4
        parts, have = [], 0
        while have < need:
            part = next(lines, None)
            if part is None:
                raise ValueError("record cut short")
            parts += [part, b"\n"]
            have += len(part) + 1
        data = b"".join(parts)
        if data[need - 4 :] != b"\r\n\r\n":
            raise ValueError("record without end")
        yield head, data[: need - 4]


def _lines(batches) -> Iterator[bytes]:
    for batch in batches:
        for value in batch.column(0).cast(pa.binary()):
            yield value.as_py()


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def sound(payload: bytes, said: str | None) -> bytes:
    """The payload, if it has the digest that its headers give."""
    if said is not None and digest(payload) != said:
        raise ValueError(f"payload does not have the digest {said}")
    return payload


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


PARSED = pa.schema([
    ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("kind", pa.string()),
    ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("block", pa.binary()),
])
FLUSH = 1 << 24


def _parse(batches):
    rows, held = [], 0
    for head, block in records(_lines(batches)):
        number = lambda name: int(head[name]) if name in head else None  # noqa: B023, E731
        refers = _bare(head.get("warc-refers-to"))
        said = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size = None
        if head["warc-type"] == "response" and "warc-segment-number" not in head:
            block = sound(payload_of(block), said)
            size = len(block)
        rows.append({
            "origin": _bare(head.get("warc-segment-origin-id") or head["warc-record-id"]),
            "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"),
            "kind": head["warc-type"], "page_id": number("x-page-id"), "url": head.get("warc-target-uri"),
            "refers_to": int(refers.split(":")[2]) if refers else None,
            "payload_digest": said, "payload_bytes": size, "block": block,
        })
        held += len(block) + 200
        if held > FLUSH:
            yield pa.RecordBatch.from_pylist(rows, schema=PARSED)
            rows, held = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema=PARSED)


SQL_PARSED = (
    "origin string, segment long, total long, kind string, page_id long, url string, "
    "refers_to long, payload_digest string, payload_bytes long, block binary"
)


def _decoded(frame: DataFrame) -> DataFrame:
    """Reassembled blocks to payloads."""

    def decode(batches):
        for batch in batches:
            said, blocks = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            payloads = [sound(payload_of(block), want) for want, block in zip(said, blocks, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([len(p) for p in payloads], pa.int64()),
                 pa.array(payloads, pa.binary())],
                names=[*NAMES, "payload_bytes", "payload"],
            )

    return frame.select(*NAMES, "block").mapInArrow(
        decode, "record_type string, page_id long, url string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary"
    )


NAMES = ["record_type", "page_id", "url", "refers_to", "payload_digest"]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record under ``path``: record_type, page_id, url, refers_to, payload_digest,
    payload_bytes and payload (binary; NULL for a revisit, which has the size of what it refers to).

    A record cut short, a missing segment, a wrong total length or a wrong digest raises.
    """
    lines = spark.read.schema("value string").option("lineSep", "\n").text(path)
    parsed = stage(lines.mapInArrow(_parse, SQL_PARSED), "records").withColumnRenamed("kind", "record_type")
    payload = F.when(F.col("record_type") == "response", F.col("block")).alias("payload")
    whole = parsed.where("segment IS NULL").select(*NAMES, "payload_bytes", payload)
    parts = F.sort_array(F.collect_list(F.struct("segment", "total", "block")))
    joined = (
        parsed.where("segment IS NOT NULL").groupBy("origin")
        .agg(parts.alias("parts"), *[F.first(c, ignorenulls=True).alias(c) for c in NAMES[1:]])
        .withColumn("block", F.aggregate(
            "parts", F.lit(b""), lambda done, part: F.concat(done, part["block"])
        ))
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    size = F.size("parts").cast("long")
    total = F.element_at("parts", -1)["total"]
    complete = (numbers == F.sequence(F.lit(1).cast("long"), size)) & (F.octet_length("block") == total)
    fault = F.raise_error(F.concat(F.lit("segments missing or of wrong length: "), "origin")).cast("binary")
    checked = joined.withColumn("record_type", F.lit("response")).withColumn(
        "block", F.when(F.coalesce(complete, F.lit(False)), F.col("block")).otherwise(fault)
    )
    pages = whole.union(_decoded(checked))
    sizes = (
        pages.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("__of"), F.col("payload_digest").alias("__digest"))
        .agg(F.max("payload_bytes").alias("__bytes"))
    )
    match = (F.col("refers_to") == F.col("__of")) & (F.col("payload_digest") == F.col("__digest"))
    return pages.join(stage(sizes, "sizes"), match, "left").select(
        *NAMES, F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"), "payload"
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """``pages`` written as archives to the shared folder and read back."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "archives")
    write_archives(pages, path, **options)
    return read_archives(spark, path)
