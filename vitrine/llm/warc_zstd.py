"""WARC archives compressed with zstandard: a writer and a validating reader.

An archive starts with a skippable frame that holds its dictionary, then has one frame for each
record, so any record can be decoded alone. The reader loads the dictionary from that frame (raw,
or itself a zstandard frame), decodes frame by frame and checks version line, header syntax,
needed headers, Content-Length against the block, block and payload digests.

Which records are revisits is decided on digests alone: (page, digest, length) rows are grouped by
digest with partial aggregation, so the copies of one page are one row per task. Pages are then
dealt out by page, never by digest. Every task writes archives of at most ``ARCHIVE_BYTES`` of
records through a file system that its URI names (file, hdfs, s3, ...), under a temporary name and
moved when complete. Rows are sorted inside their task, so a repeated task writes the same archives
under the same names again.

Rows: a null payload is empty; a null page id is kept as an empty header and read back as null, and
a group of equal payloads whose ids are all null has no revisits; repeated rows are records of
their own, and all rows with the largest id of a group are responses; an empty table writes no
archives; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..stages import stage_path
from ..workers import ship_package
from .common import text_or_empty

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 65_536
#: Records that a dictionary is trained on: the first of an archive.
DICTIONARY_RECORDS, DICTIONARY_SAMPLE_BYTES = 200, 2 << 20
LEVEL = 3

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


class WarcError(ValueError):
    """An archive or a record breaks the format."""


# --- records -----------------------------------------------------------------------------------


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def build_record(kind: str, identifier: str, url: str, payload: bytes, page: str, refers_to: str | None) -> bytes:
    """The bytes of a record. A revisit has the HTTP head only; its payload digest is that of the full payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + payload if kind == "response" else head
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", identifier),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", base32_sha1(payload)),
        ("WARC-Block-Digest", base32_sha1(block)),
        ("X-Page-ID", page),
    ]
    if kind == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page", refers_to or "")]
    headers.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in headers)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def one_line(value: str | None) -> str:
    """A header value without line breaks and outer blanks."""
    return " ".join((value or "").split())


def parse_head(data: bytes, what: str) -> tuple[list[tuple[str, str]], bytes]:
    """Header fields up to the empty line, and the bytes after it."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError(f"{what}: the header has no end")
    fields = []
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip() or name != name.strip():
            raise WarcError(f"{what}: not a header line: {line[:60]!r}")
        fields.append((name.decode("ascii", "replace"), value.strip().decode("utf-8", "replace")))
    return fields, rest


def parse_record(data: bytes) -> dict:
    """Headers, block, payload and declared payload length of a record; raises WarcError if it is not valid."""
    first, _, rest = data.partition(b"\r\n")
    if not first.startswith(b"WARC/1."):
        raise WarcError(f"no WARC version line: {first[:40]!r}")
    fields, rest = parse_head(rest, "record")
    headers = {name.lower(): value for name, value in fields}
    for name in NEEDED:
        if name.lower() not in headers:
            raise WarcError(f"record without {name}")
    size = headers["content-length"]
    if not size.isdigit():
        raise WarcError(f"Content-Length is not a number: {size!r}")
    block, end = rest[: int(size)], rest[int(size) :]
    if len(block) != int(size) or end != b"\r\n\r\n":
        raise WarcError(f"Content-Length {size} does not fit {len(rest)} bytes after the header")
    if headers.get("warc-block-digest", base32_sha1(block)) != base32_sha1(block):
        raise WarcError("the block digest does not fit the block")
    out = {"headers": headers, "kind": headers["warc-type"], "payload": None, "payload_bytes": None}
    if headers.get("content-type", "").startswith("application/http"):
        _, gap, inner = block.partition(b"\r\n")
        if not gap:
            raise WarcError("HTTP block without a status line")
        http, payload = parse_head(inner, "HTTP block")
        declared = next((v for k, v in http if k.lower() == "content-length"), None)
        if declared is not None and not declared.isdigit():
            raise WarcError(f"HTTP Content-Length is not a number: {declared!r}")
        out["payload_bytes"] = int(declared) if declared is not None else len(payload)
        if out["kind"] != "revisit":
            if len(payload) != out["payload_bytes"]:
                raise WarcError(f"HTTP Content-Length {declared} for {len(payload)} bytes")
            if headers.get("warc-payload-digest", base32_sha1(payload)) != base32_sha1(payload):
                raise WarcError("the payload digest does not fit the payload")
            out["payload"] = payload
        elif payload:
            raise WarcError("revisit with a payload")
    return out


# --- archives ----------------------------------------------------------------------------------


def train(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n"


def archive_head(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def write_archive(records: list[bytes]) -> bytes:
    """Dictionary frame, then a frame per record."""
    import zstandard

    samples, size = [], 0
    for record in records[:DICTIONARY_RECORDS]:
        if size + len(record) > DICTIONARY_SAMPLE_BYTES and samples:
            break
        samples.append(record)
        size += len(record)
    dictionary = train(samples)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)
    return archive_head(dictionary) + b"".join([packer.compress(r) for r in records])


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame after the other."""
    import zstandard

    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        raw = data[8 : 8 + size]
        if len(raw) != size:
            raise WarcError("the dictionary frame is cut off")
        if raw.startswith(ZSTD_MAGIC):
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
        at = 8 + size
    opener = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary is not None else zstandard.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        if len(data) - at >= 8 and struct.unpack_from("<I", data, at)[0] & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]  # other skippable frames
            continue
        if data[at : at + 4] != ZSTD_MAGIC:
            raise WarcError(f"no frame at byte {at}")
        frame = opener.decompressobj()
        try:
            parts, step = [], 1 << 16
            while not frame.eof:
                if at >= len(data):
                    raise WarcError("the last frame is cut off")
                piece = view[at : at + step]
                parts.append(frame.decompress(piece))
                at += len(piece)
            at -= len(frame.unused_data)
        except zstandard.ZstdError as broken:
            raise WarcError(f"frame that cannot be decoded: {broken}") from broken
        yield b"".join(parts)


# --- Spark jobs --------------------------------------------------------------------------------


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page, url, payload (binary), kind, refers_to for every row.

    Copies are recognised by the SHA-256 of their payloads; the payload itself only moves to its page.
    """
    payload = text_or_empty(payload_col).cast("binary")
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"))
    digests = rows.select("page", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
    groups = digests.filter(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.max("page").alias("chief"), F.count("*").alias("copies"))
    revisits = digests.join(groups.filter("copies > 1"), "digest").filter(~F.col("page").eqNullSafe(F.col("chief")) & F.col("chief").isNotNull())
    # Repeated rows share page and digest, so they share the verdict.
    revisits = revisits.select(F.xxhash64("page").alias("r_page"), F.col("digest").alias("r_digest"), "chief").distinct()
    keyed = rows.withColumns({"k_page": F.xxhash64("page"), "k_digest": F.sha2("payload", 256)})
    joined = keyed.join(revisits, (F.col("k_page") == F.col("r_page")) & (F.col("k_digest") == F.col("r_digest")), "left")
    return joined.select("page", "url", "payload", F.when(F.col("chief").isNull(), F.lit("response")).otherwise(F.lit("revisit")).alias("kind"), F.col("chief").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> DataFrame:
    """Write a record per row; returns (path, records, bytes) of the archives. Runs when it is read, so write it out once."""
    spark = pages.sparkSession
    ship_package(spark)
    root = folder or stage_path(spark, "archives")
    planned = plan_records(pages, **columns)
    planned = planned.sortWithinPartitions("page", F.xxhash64("payload"), "url")
    planned = planned.select(F.col("page").cast("string").alias("page"), "url", "payload", "kind", F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        records: list[bytes] = []
        held, number = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal records, held, number
            data = write_archive(records)
            name = f"{base}/part-{part:05d}-{number:04d}.warc.zst"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(f"{name}.{attempt}.tmp") as out:
                out.write(data)
            store.move(f"{name}.{attempt}.tmp", name)
            made = pa.RecordBatch.from_pydict({"path": [name], "records": pa.array([len(records)], pa.int64()), "bytes": pa.array([len(data)], pa.int64())})
            records, held, number = [], 0, number + 1
            return made

        for batch in batches:
            for page, url, payload, kind, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                place = f"{part}/{number}"
                record = build_record(kind, record_id(place, len(records)), one_line(url), payload, page or "", refers_to)
                if records and held + len(record) > archive_bytes:
                    yield flush()
                records.append(record)
                held += len(record)
        if records:
            yield flush()

    return planned.mapInArrow(run, "path string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: record_type, record_id, url, page, refers_to, payload_digest (bare hexadecimal
    SHA-1), payload_bytes, payload, error (why a record or the rest of an archive is not valid, else null).

    Archives are read by Spark's binary file source, from any store it reads; each must fit a task.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    names = ["path", "record_type", "record_id", "url", "page", "refers_to", "payload_digest", "payload_bytes", "payload", "error"]
    kinds = [pa.string()] * 7 + [pa.int64(), pa.binary(), pa.string()]
    schema = "path string, record_type string, record_id string, url string, page string, refers_to string, payload_digest string, payload_bytes long, payload binary, error string"

    def row(path: str, record: bytes) -> tuple:
        try:
            found = parse_record(record)
        except WarcError as wrong:
            return (path, *[None] * 8, str(wrong))
        headers = found["headers"]
        digest = headers.get("warc-payload-digest", "")
        bare = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
        if bare is None and found["payload"] is not None:
            bare = hashlib.sha1(found["payload"]).hexdigest()
        page, refers = headers.get("x-page-id") or None, headers.get("x-refers-to-page") or None
        return path, found["kind"], headers["warc-record-id"], headers.get("warc-target-uri"), page, refers, bare, found["payload_bytes"], found["payload"], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, held = [], 0
                try:
                    for record in read_archive(content.as_py()):
                        rows.append(row(path, record))
                        held += len(record)
                        if held > 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                except WarcError as wrong:
                    rows.append((path, *[None] * 8, str(wrong)))
                if rows:
                    yield packed(rows)

    return files.mapInArrow(run, schema)


def page_digests(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records read back.

    A revisit is resolved through the response it names: its length comes from there, and a revisit
    whose response is missing or has another payload has a null length.
    """
    rows = records.filter("error IS NULL").select("page", "refers_to", "record_type", "payload_digest", "payload_bytes")
    responses = rows.filter("record_type = 'response'").select(F.col("page").alias("t_page"), F.col("payload_digest").alias("t_digest"), F.col("payload_bytes").alias("t_bytes"))
    named = rows.filter("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    targets = responses.join(named, (F.col("t_page") == F.col("refers_to")) & (F.col("t_digest") == F.col("payload_digest")), "left_semi").distinct()
    joined = rows.join(targets, (F.col("refers_to") == F.col("t_page")) & (F.col("payload_digest") == F.col("t_digest")), "left")
    size = F.when(F.col("record_type") == "revisit", F.col("t_bytes")).otherwise(F.col("payload_bytes"))
    return joined.select(
        F.col("page").cast(id_type).alias("page_id"), size.alias("payload_bytes"), "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to")
    )


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives and read them back."""
    spark = pages.sparkSession
    root = folder or stage_path(spark, "archives")
    written = write_archives(pages, root).agg(F.sum("records")).first()[0] or 0
    if not written:
        return spark.createDataFrame([], "page_id bigint, payload_bytes long, payload_digest string, record_type string, refers_to bigint")
    return page_digests(read_archives(spark, root), dict(pages.dtypes)["page_id"])
