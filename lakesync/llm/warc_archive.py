"""WARC archives in the dictionary-compressed form: one Zstandard dictionary in a leading skippable frame of each
file, every record in a frame of its own, so that a record can be read without those before it.

The dictionary is trained on a sample of the distinct payloads, drawn by their digests: SAMPLE_RECORDS of them on
average, of a longer one a piece of SAMPLE_CHARS characters at a place that its digest says. Where training finds too
little, the end of the sample itself is a raw dictionary, and without a sample there is none. Files are written to the
folder that all machines share, under a name that no other attempt of a task uses; which of them count says the table
of archives that the write returns, so that what a lost attempt left behind is never read.

Of records with equal payloads of DEDUP_BYTES or more the one with the smallest id is a response and the others
revisit it; rows that share that smallest id are all responses. A null payload is empty; a null id or url leaves out
its field, and null ids revisit like others (as response only where all are null). Repeated rows are written once
each. An empty table gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, small_batches, spread_join

DEDUP_BYTES = 100
SAMPLE_RECORDS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 65_536, 64 * 1024
#: A file is closed beyond this size; the next one gets a dictionary frame of its own.
FILE_BYTES = 64 << 20
LEVEL = 6
# Fixed values of the formats.
SKIPPABLE_MAGIC, FRAME_MAGIC, DICTIONARY_MAGIC = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(path: str):
    """A file system and the path in it, for local paths and any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{os.path.abspath(path)}")


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _fields(pairs: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode()


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit (refers_to given) with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    block = http + (payload if refers_to is None else b"")
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=~")), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Page-ID", None if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page-ID", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return f"{VERSION}\r\n".encode() + _fields(head) + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a record; its lengths and block digest are verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
    if end != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where there are too few to train on; none without samples."""
    import zstandard

    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes):
    import zstandard

    trained = data[:4] == struct.pack("<I", DICTIONARY_MAGIC)
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame at `at` ends: its header, its blocks and its checksum are stepped over."""
    import zstandard

    info = zstandard.get_frame_parameters(bytes(data[at : at + 18]))
    checksum, at = 4 * info.has_checksum, at + zstandard.frame_header_size(bytes(data[at : at + 18]))
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + checksum


def read_archive(content: bytes) -> Iterator[bytes]:
    """The records of one archive, by nothing but its bytes."""
    import zstandard

    data, at, extra = memoryview(content), 0, {}
    while at < len(data):
        magic, size = struct.unpack("<II", data[at : at + 8])
        if magic == SKIPPABLE_MAGIC:
            held = bytes(data[at + 8 : at + 8 + size])
            if held[:4] == struct.pack("<I", FRAME_MAGIC):
                held = zstandard.ZstdDecompressor().decompress(held)
            extra, at = {"dict_data": _dictionary(held)} if held else {}, at + 8 + size
            reader = zstandard.ZstdDecompressor(**extra)
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        end = _frame_end(data, at)
        yield reader.decompress(data[at:end])
        at = end


def _writer(folder: str, dictionary: bytes):
    """A function for mapInPandas that writes its rows to archives in folder and returns path, records and bytes of each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        task, files = TaskContext.get(), []
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **({"dict_data": _dictionary(dictionary)} if dictionary else {}))
        store, root = open_store(folder)
        out, name, records, size = None, "", 0, 0

        def close() -> None:
            if out is not None:
                out.close()
                files.append((f"{folder}/{name}", records, size))

        for rows in batches:
            for page_id, url, html, digest, refers_to in zip(rows["page_id"], rows["url"], rows["html"], rows["digest"], rows["refers_to"], strict=True):
                if out is None or size > FILE_BYTES:
                    close()
                    name = f"pages-{task.partitionId():05d}-{len(files):03d}-{task.taskAttemptId()}.warc.zst"
                    out, records = store.open_output_stream(f"{root}/{name}"), 0
                    size = out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed)
                frame = packer.compress(warc_record(page_id, url, html.encode(), digest, refers_to))
                out.write(frame)
                records, size = records + 1, size + len(frame)
        close()
        yield pd.DataFrame(files, columns=["path", "records", "bytes"])

    return write


def _sample(rows: DataFrame, share: float) -> list[bytes]:
    """Distinct payloads, or pieces of them, whose digest falls into the share; in order of the digests."""
    place = F.xxhash64(F.lit(5), "digest")
    drawn = rows.where((F.xxhash64("digest") / F.lit(2.0**64) + 0.5 < share) & (F.length("html") > 0))
    piece = F.substring("html", 1 + F.pmod(place, F.greatest(F.length("html") - SAMPLE_CHARS + 1, F.lit(1))).cast("int"), F.lit(SAMPLE_CHARS))
    held = drawn.select("digest", piece.alias("piece")).groupBy("digest").agg(F.first("piece").alias("piece")).collect()
    return [r["piece"].encode() for r in sorted(held, key=lambda r: r["digest"])]


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row into archives under folder (shared by all machines); returns path, records, bytes of each archive.

    The result is a table that has been written: reading it again writes no archive anew.
    """
    spark = pages.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "warc")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    payloads = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.max(F.octet_length("html")).alias("bytes"))
    payloads = scratch.table(payloads, "payloads")
    dictionary = build_dictionary(_sample(rows, SAMPLE_RECORDS / max(payloads.count(), 1)))
    first = payloads.where((F.col("bytes") >= DEDUP_BYTES) & (F.col("n") > 1)).select("digest", "first_id")
    dealt = spread_join(rows, first, "digest", F.struct("page_id", "url"), payloads, "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    dealt = dealt.select(F.col("page_id").cast("string"), "url", "html", "digest", refers_to.cast("string").alias("refers_to"))  # as text: pandas would make floats of nullable numbers
    store, root = open_store(folder)
    store.create_dir(root)
    return scratch.table(dealt.mapInPandas(_writer(folder, dictionary), "path string, records long, bytes long"), "archives")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
#: Rows and payload bytes after which the reader hands on what it has; archives that one task reads on average.
READ_ROWS, READ_BYTES, READ_FILES = 256, 8 << 20, 4


def _rows_of(content: bytes) -> Iterator[tuple]:
    for raw in read_archive(content):
        fields, http, payload = parse_record(raw)
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
        if kind == "response" and (digest != hashlib.sha256(payload).hexdigest() or len(payload) != int(http["Content-Length"])):
            raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
        page_id, refers_to = (int(fields[name]) if name in fields else None for name in ("Page-ID", "Refers-To-Page-ID"))
        yield page_id, fields.get("WARC-Target-URI"), int(http["Content-Length"]), digest, kind, refers_to, payload if kind == "response" else None


def _read(batches):
    import pyarrow as pa

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = [column.split()[0] for column in RECORD.split(", ")]
    packed = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    for archives in batches:
        for path in archives.column(0).to_pylist():
            store, file = open_store(path)
            with store.open_input_stream(file) as source:
                content = source.read()
            rows, size = [], 0
            for row in _rows_of(content):
                rows.append(row)
                size += len(row[-1] or b"")
                if len(rows) == READ_ROWS or size > READ_BYTES:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the archives whose paths are in archives' column path, payloads verified against their digests; a revisit has none of its own."""
    tasks = -(-archives.count() // READ_FILES)
    return archives.select("path").repartition(max(tasks, archives.sparkSession.sparkContext.defaultParallelism)).mapInArrow(_read, RECORD)


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_archives(read_table(spark, sf_dir, "pages"), Scratch(spark, "archives").path("warc"))
    return read_archives(written).drop("payload", "url")


OP9_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN first USING (payload_digest)
"""
