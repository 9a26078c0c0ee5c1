"""WARC archives of pages, and back: segments, revisits and chunked framing.

Writing makes one response record for each payload, split into continuation
records when it is long, and revisit records for further pages with the payload.
Every record is a gzip member of its own, and each file begins with a warcinfo record.
Reading parses the archives, groups continuation records by their origin, puts
them in segment order, verifies the total length, decodes the chunked transfer
framing, and looks up what a revisit refers to.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, materialize, scratch_path, small_batches

SEGMENT_BYTES = 32 << 10
#: A member's last byte is zero below 16 MB of record, and the text writer adds it.
MOST_SEGMENT_BYTES = 8 << 20
CHUNK_BYTES = 8 << 10
#: Records of one archive file; with the segment size, this bounds a file.
RECORDS_PER_FILE = 2000
#: Compressed bytes that reading inflates at a time, and bytes that they may become.
READ_BYTES, INFLATED_BYTES = 64 << 10, 4 << 20
#: Bytes of an archive file at most.
MOST_ARCHIVE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("kind", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers", pa.string()), ("origin", pa.string()), ("copy", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("content", pa.string())])
RESPONSE = pa.schema([PARSED.field(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_id", "target_uri")])
PARSED_SQL = "page_id long, payload_bytes long, payload_digest string, kind string, record_id string, target_uri string, refers string, origin string, copy string, segment int, total long, block binary, content string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for i in range(0, len(payload), size) if (p := payload[i : i + size])]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(framed: bytes) -> bytes:
    """What chunks hold; extensions of chunks and trailer fields after the last one are passed over."""
    out, at = [], 0
    while True:
        stop = framed.index(b"\r\n", at)
        n = int(framed[at:stop].split(b";")[0].strip(), 16)
        if not n:
            end = stop if framed[stop:].startswith(b"\r\n\r\n") else framed.index(b"\r\n\r\n", stop + 2)
            if end + 4 != len(framed):
                raise ValueError("chunked body goes on after its end")
            return b"".join(out)
        out.append(framed[stop + 2 : stop + 2 + n])
        if framed[stop + 2 + n : stop + 4 + n] != b"\r\n":
            raise ValueError("chunk without its end")
        at = stop + 4 + n


def fields_of(head: bytes) -> dict[str, str]:
    """Fields below the first line of a head, by lower-case name; the first of repeated ones. A line that begins with space goes on with the field before it."""
    lines: list[str] = []
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        else:
            lines.append(line)
    out: dict[str, str] = {}
    for name, colon, value in (x.partition(":") for x in lines):
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def http_payload(block: bytes, content_type: str) -> tuple[bytes, bytes]:
    """The payload of a response, without transfer framing, and as it stands. A block that is no HTTP message is payload as a whole."""
    if content_type and not content_type.lower().startswith("application/http"):
        return block, block
    stop = block.find(b"\r\n\r\n")
    if stop < 0:
        raise ValueError("HTTP head without its end")
    body = block[stop + 4 :]
    codings = fields_of(block[:stop]).get("transfer-encoding", "").lower().split(",")
    return (dechunked(body) if codings[-1].strip() == "chunked" else body), body


def agrees(claimed: str | None, *payloads: bytes) -> bool:
    """Whether a digest field is that of one of the payloads; so is none at all, or one by an unknown algorithm."""
    name, colon, value = (claimed or "").partition(":")
    name = name.strip().lower().replace("-", "")
    if not colon or name not in ("sha1", "md5", "sha256", "sha512"):
        return True
    for payload in payloads:
        raw = hashlib.new(name, payload).digest()
        if value.strip().lower() == raw.hex() or value.strip().upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("="):
            return True
    return False


def record(fields: dict, block: bytes) -> bytes:
    """One record as a gzip member, without its last byte, a zero."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    whole = b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
    return (deflate.compress(whole) + deflate.flush())[:-1]


def record_id(page, of: str) -> str:
    """The id of a page's record, from its number and payload digest; a repeated row repeats its record and so its id."""
    return f"<urn:page:{'' if page is None else page}:{of}>"


def _head(page, url: str | None, of: str) -> dict:
    target = (url or "").replace("\r", "").replace("\n", "") or None
    return {"WARC-Type": "response", "WARC-Record-ID": record_id(page, of), "WARC-Date": DATE, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{of}", "X-Page": page}


def revisit_record(page, url: str | None, key: bytes, first: int) -> bytes:
    of = base64.b32encode(key).decode()
    return record(_head(page, url, of) | {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": record_id(first, of)}, b"")


def response_records(page, url: str | None, payload: bytes, copy: str, segment_bytes: int, chunk_bytes: int):
    fields = _head(page, url, digest(payload))
    own = fields["WARC-Record-ID"]
    block = HTTP + chunked(payload, chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    fields["Content-Type"] = "application/http; msgtype=response"
    if len(parts) == 1:
        yield record(fields, block)
        return
    for n, part in enumerate(parts, 1):
        if n == 1:
            yield record(fields | {"WARC-Segment-Number": 1, "X-Copy": copy}, part)
        else:
            total = len(block) if n == len(parts) else None
            yield record({"WARC-Type": "continuation", "WARC-Record-ID": f"{own[:-1]}:{n}>", "WARC-Date": DATE, "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": n, "WARC-Segment-Total-Length": total, "X-Copy": copy}, part)


def revisits_of(rows: DataFrame) -> DataFrame:
    """(page_id, url, key, first) of the rows (page_id, url, key) that revisit the smallest page_id with their payload."""
    rows = materialize(rows, "payload-keys")
    shared = materialize(rows.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "shared-payloads")
    return join_counted(rows, shared, "key").where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", "url", "key", "first")


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write gzip WARC files of pages (page_id, url, html).

    Of pages with equal payloads the one with the smallest page_id is the
    response. A null html is an empty payload. Rows that repeat the smallest
    page_id are responses each; a null page_id never is one beside a known one.
    Payloads are shuffled once, by page, and only to leave out those of revisits;
    what pages share is found among their digests.
    """
    if not 0 < segment_bytes <= MOST_SEGMENT_BYTES:
        raise ValueError(f"segments have 1 to {MOST_SEGMENT_BYTES} bytes")
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).withColumn("key", F.unhex(F.sha1("payload")))
    revisits = materialize(revisits_of(rows.select("page_id", "url", "key")), "revisits")
    gone = revisits.select(F.col("page_id").alias("p"), F.col("key").alias("k")).distinct()
    responses = rows.join(gone, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("key") == F.col("k")), "left_anti")

    def written(make):
        def run(batches):
            part, n, rows_seen = TaskContext.get().partitionId(), 0, 0
            for batch in batches:
                out, held = [], 0
                for values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    rows_seen += 1
                    for made in make(f"{part}-{rows_seen}", *values):
                        if n % records_per_file == 0:
                            info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{part}-{n}>", "WARC-Date": DATE, "Content-Type": "application/warc-fields"}
                            out.append(record(info, b"format: WARC File Format 1.1\r\n"))
                            n += 1
                        out.append(made)
                        n += 1
                        held += len(made)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

        return run

    whole = responses.select("page_id", "url", "payload").mapInArrow(written(lambda copy, page, url, payload: response_records(page, url, payload, copy, segment_bytes, chunk_bytes)), "value binary")
    again = revisits.mapInArrow(written(lambda _, page, url, key, first: [revisit_record(page, url, key, first)]), "value binary")
    made = whole.unionByName(again).select(F.col("value").cast("string").alias("value"))
    made.write.option("lineSep", "\x00").option("maxRecordsPerFile", records_per_file).text(path)


def inflated(data: bytes):
    """Pieces of what the gzip members of an archive hold; an archive that ends within one raises."""
    at, inflate = 0, zlib.decompressobj(31)
    while data:
        if inflate.eof:
            if at == len(data):
                return
            inflate = zlib.decompressobj(31)
        given = data[at : at + READ_BYTES]
        more = inflate.decompress(given, INFLATED_BYTES)
        at += len(given) - len(inflate.unused_data) - len(inflate.unconsumed_tail)
        if not given and not more and not inflate.eof:
            raise ValueError("archive ends within a gzip member")
        if more:
            yield more


def parse(data: bytes):
    """(fields, block) of each record of an archive: gzip members of one or more records each."""
    held, at, pieces = b"", 0, inflated(data)
    while True:
        stop = held.find(b"\r\n\r\n", at)
        if stop >= 0:
            fields = fields_of(held[at:stop].lstrip(b"\r\n"))
            end = stop + 4 + int(fields["content-length"])
            if len(held) >= end + 4:
                yield fields, held[stop + 4 : end]
                at = end + 4
                continue
        more = next(pieces, None)
        if more is None:
            if held[at:].strip():
                raise ValueError("archive ends within a record")
            return
        held, at = held[at:] + more, 0


def _response(page, block: bytes, kind: str, claimed: str | None, own: str, target: str | None) -> tuple:
    payload, body = http_payload(block, kind)
    if not agrees(claimed, payload, body):
        raise ValueError(f"{own}: payload digest {digest(payload)}, {claimed} recorded")
    return page, len(payload), digest(payload), own, target


def _parsed(fields: dict, block: bytes) -> tuple | None:
    """A row of PARSED for a record; None for one that is no part of a page."""
    kind, own, claimed = fields["warc-type"].lower(), fields["warc-record-id"], fields.get("warc-payload-digest")
    page, target, content = (int(fields["x-page"]) if "x-page" in fields else None), fields.get("warc-target-uri"), fields.get("content-type", "")
    if kind == "revisit":
        return page, None, claimed, kind, own, target, fields.get("warc-refers-to"), *[None] * 6
    if "warc-segment-number" in fields and kind in ("response", "continuation"):
        total, n = fields.get("warc-segment-total-length"), int(fields["warc-segment-number"])
        return page, None, claimed, kind, own, target, None, fields.get("warc-segment-origin-id", own), fields.get("x-copy", ""), n, total and int(total), block, content
    if kind == "response":
        page, size, found, own, target = _response(page, block, content, claimed, own, target)
        return page, size, found, kind, own, target, *[None] * 7
    return None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, path: str, resolve: bool = True) -> DataFrame:
    """Pages of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, target_uri.

    Archives may come from other writers: names of fields in any case, bodies with or
    without chunked framing and trailer fields, digests of several kinds, of the
    payload or of its framed form, or none, records of other types, which are passed over, and
    no page_id, which is then null.

    A missing or repeated segment, a wrong total length or digest, a broken frame, an
    archive cut off, and a revisit of a record that is not there raise: such archives
    were not written whole. Without ``resolve`` such a revisit has no size. Segments may
    stand in any order and in different files. A revisit's size is that of the
    response it refers to, by record id, or else by digest. Files of more than
    MOST_ARCHIVE_BYTES raise, as one task holds a file.
    """
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path)
    if not (largest := files.agg(F.max("length")).first()[0] or 0) <= MOST_ARCHIVE_BYTES:
        raise ValueError(f"an archive has {largest} bytes, {MOST_ARCHIVE_BYTES} are the most")

    def run(batches):
        for batch in batches:
            for data in batch["content"]:
                rows = []
                for fields, block in parse(data.as_py()):
                    if row := _parsed(fields, block):
                        rows.append(row)
                    if len(rows) >= 1000:
                        yield _batch(rows, PARSED)
                        rows = []
                if rows:
                    yield _batch(rows, PARSED)

    def join(batches):
        for batch in batches:
            rows = []
            for origin, parts in zip(batch["origin"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                block = b"".join(p["block"] for p in parts)
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block):
                    raise ValueError(f"{origin}: segments are missing, repeated or of another length")
                head = parts[0]
                rows.append(_response(head["page_id"], block, head["content"], head["payload_digest"], origin, head["target_uri"]))
            if rows:
                yield _batch(rows, RESPONSE)

    parsed = materialize(files.select("content").mapInArrow(run, PARSED_SQL), "warc-records")
    whole = parsed.where("origin is null and kind = 'response'").select(*RESPONSE.names)
    held = F.struct("segment", "total", "block", "page_id", "payload_digest", "content", "target_uri")
    parts = parsed.where("origin is not null").groupBy("origin", "copy").agg(F.array_sort(F.collect_list(held)).alias("parts"))
    joined = materialize(parts.mapInArrow(join, "page_id long, payload_bytes long, payload_digest string, record_id string, target_uri string"), "warc-joined")
    responses = whole.unionByName(joined)
    # A digest as the field has it, in the form that responses have.
    bare = F.upper(F.regexp_extract(F.coalesce("payload_digest", F.lit("")), "(?i)^sha-?1:([A-Z2-7]{32})$", 1))
    revisits = parsed.where("kind = 'revisit'").select("page_id", "target_uri", F.col("record_id").alias("own"), F.coalesce("refers", F.concat(F.lit("sha1:"), bare), F.lit("")).alias("refers"), bare.alias("claimed"))
    wanted = revisits.groupBy("refers").agg(F.count("*").alias("n"))
    named = F.explode(F.array("record_id", F.concat(F.lit("sha1:"), "payload_digest"))).alias("refers")
    known = responses.select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest", named).join(wanted, "refers")
    first = F.min(F.struct(F.col("refers_to").isNull().alias("unnamed"), "refers_to", "payload_bytes", "payload_digest")).alias("first")
    targets = wanted.join(known.groupBy("refers").agg(first), "refers", "left").select("refers", "n", "first.refers_to", "first.payload_bytes", "first.payload_digest")
    targets = materialize(targets, "warc-targets")
    sound = F.coalesce((F.col("payload_digest") == F.col("claimed")) | (F.col("payload_digest").isNotNull() & (F.col("claimed") == "")), F.lit(False))
    size = F.col("payload_bytes")
    if resolve:
        size = F.when(sound, size).otherwise(F.raise_error(F.concat(F.lit("no response with this payload: "), F.col("refers"))).cast("long"))
    again = join_counted(revisits, targets, "refers").select("page_id", size.alias("payload_bytes"), F.coalesce("payload_digest", F.nullif("claimed", F.lit(""))).alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to", F.col("own").alias("record_id"), "target_uri")
    first_ones = responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "record_id", "target_uri")
    return first_ones.unionByName(again)


def round_trip(pages: DataFrame) -> DataFrame:
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).drop("record_id", "target_uri")
