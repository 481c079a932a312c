"""WARC archives compressed with Zstandard: one frame for each record, behind a dictionary.

An archive starts with a skippable frame that holds the dictionary, itself compressed or not; then every
record is a frame of its own. The writer makes one response record for each page, or a revisit record
without payload where an equal payload is already kept: of pages with equal payloads of at least
`min_bytes` bytes the one with the smallest page_id is the response.

The reader finds the frames by their block headers, so a truncated or foreign frame is noticed where it
starts; each frame must decode to exactly one record whose version line, named headers, length and payload
digest are right. What is not right is reported with its place in `problem`, or fails the query.

Equality of payloads is that of their SHA-256; rows with a payload that nobody shares do not move. Null
html counts as empty; null urls have no target; pages that repeat an id and payload are all responses if
that id is the smallest. A page without an id gets a record without one, and ids come before their lack.
An empty table writes no archive. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import marks, parted, shared_folder, small, stage, text_of

#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 8 << 20

#: The dictionary is trained on the beginnings of so many pages, and has so many bytes at most.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 500, 16_384, 64 << 10

SUFFIX = ".warc.zst"

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
SKIPPABLE_RANGE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:tidemark:page:"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
SCHEMA = (
    "archive string, offset long, length long, record_type string, page_id long, refers_to long, target string,"
    " payload_bytes long, payload_digest string, payload binary, problem string"
)


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """The bytes of a response or revisit record. Either has the HTTP headers of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{ID_PREFIX}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if revisit:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{ID_PREFIX}{refers_to}>"}
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of exactly one record; ValueError if it is not one."""
    head, end, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not end or lines[0] not in VERSIONS:
        raise ValueError("no record header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise ValueError(f"header line without a name: {line[:40]!r}")
        headers[name.strip().lower()] = value.strip()
    if missing := [name for name in REQUIRED if name not in headers]:
        raise ValueError(f"missing headers: {', '.join(missing)}")
    if not headers["content-length"].isdecimal() or len(rest) != int(headers["content-length"]) + 4:
        raise ValueError(f"{len(rest) - 4} bytes, not the {headers['content-length']} of Content-Length")
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("no end of record")
    kind, block = headers["warc-type"], rest[:-4]
    found = {"record_type": kind, "target": headers.get("warc-target-uri")}
    found["page_id"], found["refers_to"] = _page(headers["warc-record-id"]), _page(headers.get("warc-refers-to", ""))
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    sizes = [line.partition(b":")[2].strip() for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if len(sizes) != 1 or not sizes[0].isdigit():
        raise ValueError("no length of the payload")
    found["payload_bytes"] = int(sizes[0])
    found["payload_digest"] = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != found["payload_bytes"] or digest_of(payload) != found["payload_digest"]:
            raise ValueError("the payload is not that of its length and digest")
        found["payload"] = payload
    elif kind != "revisit" or payload:
        raise ValueError(f"a {kind} record" + " with a payload" * bool(payload))
    return found


def _page(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix(ID_PREFIX)
    return int(number) if number.lstrip("-").isdecimal() else None


def frame_end(data: memoryview, start: int) -> int:
    """Where the frame that begins at `start` ends, from its headers; ValueError if it is not all there."""
    try:
        (magic,) = struct.unpack_from("<I", data, start)
        if magic in SKIPPABLE_RANGE:
            end = start + 8 + struct.unpack_from("<I", data, start + 4)[0]
        elif magic == FRAME:
            flags = data[start + 4]
            single = flags >> 5 & 1
            at = start + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
            last = 0
            while not last:
                header = int.from_bytes(data[at : at + 3], "little") if at + 3 <= len(data) else -1
                if header < 0:
                    raise ValueError("a truncated frame")
                last, kind, size = header & 1, header >> 1 & 3, header >> 3
                if kind == 3:
                    raise ValueError("a block of unknown type")
                at += 3 + (1 if kind == 1 else size)
            end = at + 4 * (flags >> 2 & 1)
        else:
            raise ValueError("not a frame")
    except (struct.error, IndexError) as error:
        raise ValueError("a truncated frame") from error
    if end > len(data):
        raise ValueError("a truncated frame")
    return end


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def read_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary in the leading skippable frame, if there is one, and where the records begin."""
    if len(data) < 4 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        return None, 0
    end = frame_end(data, 0)
    held = bytes(data[8:end])
    if held[:4] == struct.pack("<I", FRAME):
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    return zstandard.ZstdCompressionDict(held), end


def read_archive(content: bytes, with_payload: bool = True) -> Iterator[dict]:
    """A row for each record, in order. After a frame without an end nothing more can be read."""
    data = memoryview(content)
    at = 0
    try:
        dictionary, at = read_dictionary(data)
        reader = zstandard.ZstdDecompressor(dict_data=dictionary)
        while at < len(data):
            end = frame_end(data, at)
            row = {"offset": at, "length": end - at}
            if struct.unpack_from("<I", data, at)[0] == FRAME:
                try:
                    row |= parse_record(reader.decompressobj().decompress(data[at:end]))
                except (ValueError, zstandard.ZstdError) as error:
                    row["problem"] = str(error)
                if not with_payload:
                    row.pop("payload", None)
                yield row
            at = end
    except (ValueError, zstandard.ZstdError) as error:
        yield {"offset": at, "length": len(data) - at, "problem": str(error)}


def train_dictionary(pages: DataFrame) -> bytes:
    """From the first few pages that Spark comes upon, which decide about nothing but the compression;
    where that is too little, the headers that all records share."""
    some = pages.select("page_id", F.substring(text_of(F.col("html")), 1, SAMPLE_CHARS).alias("text"))
    samples = [
        record(row["page_id"], "", row["text"].encode(), None, False, "") for row in some.limit(SAMPLE_PAGES).collect()
    ]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return record(0, "http://", b"<html></html>", 0, True, "")


def _decided(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, payload, revisit, refers_to."""
    payload = text_of(F.col("html")).cast("binary")
    known = pages.select("page_id", "url", payload.alias("payload")).withColumn("key", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= min_bytes
    seen = known.where(long_enough).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
    groups = stage(seen.where("pages > 1").select("key", "first"))
    several, lone = parted(known, marks(groups, F.col("key")), F.col("key"))
    rows = lone.withColumn("first", F.lit(None).cast("long")).unionByName(several.join(groups, "key", "left"))
    revisit = F.col("first").isNotNull() & long_enough & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select(
        "page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(folder)


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Write archives into a folder that all executors share; the stored list of them (archive, records).

    Every attempt of a task writes under names of its own, and only those of the attempt that ended well
    are in the list: what a lost executor left behind is never read.
    """
    dictionary = train_dictionary(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        store.create_dir(path, recursive=True)
        # Frames carry their length and a checksum.
        packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        done, out, name, count = [], None, "", 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, count = uuid.uuid4().hex + SUFFIX, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(dictionary_frame(dictionary))
                out.write(packer.compress(record(*(row[k] for k in ("page_id", "url", "payload", "refers_to", "revisit")), date)))
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, count))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count))
        names, counts = zip(*done) if done else ((), ())
        columns = [pa.array(names, pa.string()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["archive", "records"])

    return stage(_decided(pages, min_bytes).mapInArrow(write, "archive string, records long"))


def read_archives(
    spark: SparkSession, folder: str, listed: DataFrame | None = None, with_payload: bool = True, strict: bool = True
) -> DataFrame:
    """All records of the archives of a folder, or of those in `listed`.

    With `strict` a problem fails the query, and so does a listed archive that is gone or has not the listed records.
    """
    name = F.element_at(F.split("path", "/"), -1).alias("archive")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*" + SUFFIX).load(folder).select(name, "content")
    if listed is not None:
        gone = listed.join(files.select("archive"), "archive", "left_anti").limit(5).collect() if strict else []
        if gone:
            raise ValueError(f"archives listed but not there: {', '.join(row['archive'] for row in gone)}")
        files = files.join(small(listed.select("archive", "records")), "archive")
    else:
        files = files.withColumn("records", F.lit(None).cast("long"))
    fields = [field.strip().split(" ") for field in SCHEMA.split(",")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content, records in zip(*(batch.column(name) for name in ("archive", "content", "records"))):
                rows, size, count = [], 0, 0
                for row in read_archive(content.as_py(), with_payload):
                    if strict and "problem" in row:
                        raise ValueError(f"{archive.as_py()} at {row['offset']}: {row['problem']}")
                    count += 1
                    rows.append({"archive": archive.as_py(), **row})
                    size += len(row.get("payload") or b"") + 200
                    if size > 4 << 20:
                        yield _batch(rows, fields, types)
                        rows, size = [], 0
                if strict and records.as_py() not in (None, count):
                    raise ValueError(f"{archive.as_py()}: {count} records, {records.as_py()} listed")
                yield _batch(rows, fields, types)

    return files.mapInArrow(read, SCHEMA)


def _batch(rows: list[dict], fields: list[list[str]], types: dict) -> pa.RecordBatch:
    columns = [pa.array([row.get(name) for row in rows], types[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, without the payloads."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    listed = write_archives(pages, folder, min_bytes)
    if listed.isEmpty():
        return spark.createDataFrame([], SCHEMA)
    return read_archives(spark, folder, listed, with_payload=False)
