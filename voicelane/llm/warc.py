"""WARC archives: writing pages as records, reading records back.

Writing: payloads go into HTTP responses with chunked transfer framing. Blocks above
a size are split into a first record and continuation records that name it as their
origin. Equal payloads are stored once; later ones become revisit records.

Reading: archives are parsed record by record, continuation records are grouped by
origin, put in order of their segment numbers, checked against the total length and
joined; then the chunked framing is decoded and the payload checked by its digest.

Null html is an empty payload. Rows that repeat a page id each get a record of their
own; of equal payloads those with the smallest page id are responses, and a null id
counts as larger than all. Null urls are stored as empty. Extra columns are ignored.
A record that can't be read whole is returned with a status other than "ok" and a
null payload.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicelane.llm.common import small_batches, staged

MIN_SHARED_BYTES = 100
SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
RECORDS_PER_FILE = 2_048
CRLF = b"\r\n"
#: What ends every record; the text writer puts it there as its line end.
RECORD_END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORDS = (
    "record_id string, record_type string, page_id bigint, url string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, origin string, segment int, "
    "total_bytes bigint, block binary"
)
PAGES = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary, status string"
)


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; raises ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.index(CRLF, at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "surrogatepass") + block


def page_records(
    name: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
    segment_bytes: int, chunk_bytes: int,
) -> list[bytes]:
    """The records of one page, without their ends."""
    digest = hashlib.sha256(payload).hexdigest()
    common = [
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("X-Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", len(payload)),
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>")]
        refers = [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        return [_record(head + common + refers, http + CRLF)]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    head = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{name}>")]
    pieces = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    if len(pieces) == 1:
        return [_record(head + common, block)]
    records = [_record([*head, *common, ("WARC-Segment-Number", 1)], pieces[0])]
    for k, piece in enumerate(pieces[1:], 2):
        headers = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:page:{name}:{k}>"),
            ("WARC-Segment-Origin-ID", f"<urn:page:{name}>"),
            ("WARC-Segment-Number", k),
            ("WARC-Segment-Total-Length", len(block) if k == len(pieces) else None),
        ]
        records.append(_record(headers, piece))
    return records


def _build(segment_bytes: int, chunk_bytes: int, batches: Iterator[pa.RecordBatch]):
    # The names are made and stored by the same task, so a task that runs again stores
    # other names but never mixes them.
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            records = []
            for row in batch.slice(at, 256).to_pylist():
                n += 1
                records += page_records(
                    f"{row['page_id']}:{part}.{n}", row["page_id"], row["url"],
                    row["payload"], row["refers_to"], segment_bytes, chunk_bytes,
                )
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])


def with_revisits(pages: DataFrame, min_bytes: int = MIN_SHARED_BYTES) -> DataFrame:
    """page_id, url, payload, refers_to: null for pages that are stored themselves.

    Only digests and ids are grouped. The payloads that occur more than once are
    joined back; a payload may be a large share of all pages, so each is dealt over
    8 parts. Spark broadcasts that table only if its stored size allows it.
    """
    rows = small_batches(pages).select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    digest = F.unhex(F.sha2("payload", 256))
    keyed = rows.filter(F.length("payload") >= min_bytes).select("page_id", digest.alias("digest"))
    shared = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = staged(shared.filter("n > 1 and first is not null").select("digest", "first"), "payloads")
    shared = shared.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(7))))
    part = F.pmod(F.xxhash64("page_id"), F.lit(8)).cast("int")
    return (
        rows.withColumn("digest", digest).withColumn("part", part)
        .join(shared, ["digest", "part"], "left")
        .select(
            "page_id", "url", "payload",
            F.when(
                (F.length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")),
                F.col("first"),
            ).alias("refers_to"),
        )
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = MIN_SHARED_BYTES,
    segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write gzipped archives to a folder that all executors share.

    Records are bounded by ``segment_bytes`` and files by ``records_per_file``, so no
    page, however long, makes a file that a reader can't hold.
    """
    build = functools.partial(_build, segment_bytes, chunk_bytes)
    records = with_revisits(pages, min_bytes).mapInArrow(build, "record binary")
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", RECORD_END).option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + len(RECORD_END)


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _parse(segmented: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for h, block in parse_records(zlib.decompress(content.as_py(), 47)):
                segment = _number(h.get("WARC-Segment-Number"))
                if (segment is not None) != segmented:
                    continue
                kind, name = h["WARC-Type"], h["WARC-Record-ID"]
                refers = h.get("WARC-Refers-To", "").strip("<>").removeprefix("urn:page:")
                rows.append((
                    name, kind, _number(h.get("X-Page-Id")), h.get("WARC-Target-URI", ""),
                    _number(refers), _number(h.get("X-Payload-Length")),
                    h.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
                    h.get("WARC-Segment-Origin-ID", name), segment,
                    _number(h.get("WARC-Segment-Total-Length")), block,
                ))
                if len(rows) == 512:
                    yield _records_batch(rows, names)
                    rows = []
            if rows:
                yield _records_batch(rows, names)


def _records_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [
        pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(),
        pa.string(), pa.int32(), pa.int64(), pa.binary(),
    ]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def _decoded(kind: str, size: int, digest: str, block: bytes | None) -> tuple[bytes | None, str]:
    if block is None:
        return None, "incomplete"
    if kind == "revisit":
        return None, "ok"
    try:
        payload = unchunked(block[block.index(b"\r\n\r\n") + 4 :])
    except ValueError:
        return None, "bad_framing"
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        return None, "bad_digest"
    return payload, "ok"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PAGES.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            blocks = [
                b"".join(b) if isinstance(b, list) else b for b in part.column("block").to_pylist()
            ]
            kinds, sizes = part.column("record_type"), part.column("payload_bytes")
            done = [
                _decoded(*x) for x in zip(
                    kinds.to_pylist(), sizes.to_pylist(),
                    part.column("payload_digest").to_pylist(), blocks, strict=True,
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"), part.column("url"), kinds, part.column("refers_to"),
                    sizes, part.column("payload_digest"),
                    pa.array([p for p, _ in done], pa.binary()),
                    pa.array([s for _, s in done], pa.string()),
                ],
                names,
            )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored page, from all archives under a path.

    Whole records are decoded where they are read. Only segments of split records are
    shuffled, by the record they belong to.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(functools.partial(_parse, False), RECORDS)
    pieces = files.mapInArrow(functools.partial(_parse, True), RECORDS)
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    grouped = pieces.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total_bytes").alias("total"),
        *[first(c) for c in ("record_type", "page_id", "url", "refers_to", "payload_bytes", "payload_digest")],
    )
    size = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.length(p["block"]))
    numbers = F.transform("parts", lambda p: p["segment"])
    complete = (size == F.col("total")) & (numbers == F.sequence(F.lit(1), F.size("parts")))
    blocks = F.transform("parts", lambda p: p["block"])
    joined = grouped.select(
        F.coalesce("record_type", F.lit("continuation")).alias("record_type"), "page_id", "url",
        "refers_to", "payload_bytes", "payload_digest", F.when(complete, blocks).alias("block"),
    )
    return whole.mapInArrow(_finish, PAGES).unionByName(joined.mapInArrow(_finish, PAGES))
