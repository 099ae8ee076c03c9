"""WARC archives with a Zstandard dictionary, written and read by Spark.

An archive file begins with a skippable frame that holds a dictionary, trained on
the file's own first records; each record after it is a frame of its own,
compressed with that dictionary, so any record can be read alone. Of equal
payloads one page keeps the payload, the others revisit it.

Tasks turn pages into frames, a row per frame, and Spark's text writer lays the
rows down: its line separator is an empty skippable frame, which readers of
Zstandard pass over. So files reach any file system that Spark writes to, and a
lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import same, text_chunks, written

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty skippable frame: its magic number and a length of 0, all ASCII.
SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC[0], 0).decode("ascii")

#: Bytes of frames handed on at once, and of a frame looked at by a step of the reader.
BATCH_BYTES, STEP_BYTES = 4_000_000, 1 << 16
_NAMES = uuid.UUID("6f1d2f0e-6a0b-5c59-9a51-3f6b0f6f7a10")


def _record_id(page: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(_NAMES, f'{page}/{digest}').urn}>"


def _uri(url: str | None, page: int | None) -> str:
    if not url:
        return f"urn:page:{page}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record(page, url, payload: bytes, digest: str, first, date: str) -> bytes:
    """A response record, or a revisit record of ``first`` (id, url). Its block is an
    HTTP response, without the payload in a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if first else "response"),
        ("WARC-Record-ID", _record_id(page, digest) if not first else f"<{uuid.uuid5(_NAMES, f'{page}/{digest}/{url}').urn}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(url, page)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if page is not None:
        fields.append(("X-Page-ID", page))
    if first:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(first[0], digest)),
            ("WARC-Refers-To-Target-URI", _uri(first[1], first[0])),
            ("X-Refers-To-Page-ID", first[0]),
        ]
    block = http if first else http + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


class _Files:
    """Frames of a task's records: a dictionary row, then ``per_file`` records, and again."""

    def __init__(self, per_file: int, sample_bytes: int, dictionary_bytes: int, level: int):
        self.per_file, self.sample_bytes = per_file, sample_bytes
        self.dictionary_bytes, self.level = dictionary_bytes, level
        self.waiting: list[bytes] = []
        self.held = self.made = 0
        self.compressor = None

    def _open(self) -> Iterator[bytes]:
        """Train on the records that wait; the dictionary's frame, and theirs."""
        import zstandard

        options = {"level": self.level, "write_checksum": True}
        try:
            # segments and words looked at by the trainer: given, so it need not search for them
            trained = zstandard.train_dictionary(
                min(self.dictionary_bytes, self.held // 8), self.waiting, k=512, d=8
            )
            trained.precompute_compress(level=self.level)
            self.compressor = zstandard.ZstdCompressor(dict_data=trained, **options)
            raw = trained.as_bytes()
            yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
        except zstandard.ZstdError:  # too few records, or too much alike, to train on
            self.compressor = zstandard.ZstdCompressor(**options)
            yield b""
        for record in self.waiting:
            yield self.compressor.compress(record)
        self.made, self.waiting, self.held = len(self.waiting), [], 0

    def add(self, record: bytes) -> Iterator[bytes]:
        if self.compressor is None:
            self.waiting.append(record)
            self.held += len(record)
            if self.held >= self.sample_bytes or len(self.waiting) == self.per_file:
                yield from self._open()
        else:
            yield self.compressor.compress(record)
            self.made += 1
        if self.made == self.per_file:
            self.compressor, self.made = None, 0

    def finish(self) -> Iterator[bytes]:
        if self.waiting:
            yield from self._open()


def _batches(frames: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= BATCH_BYTES:
            yield pa.record_batch([pa.array(held, pa.binary())], names=["frame"])
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(held, pa.binary())], names=["frame"])


def write_warc(
    spark: SparkSession, pages: DataFrame, path: str, *, date: str, min_bytes: int = 100,
    records_per_file: int = 2000, sample_bytes: int = 2_000_000, dictionary_bytes: int = 65_536, level: int = 3,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> None:
    """Write a record per row of ``pages`` to archive files in the folder ``path``.

    Of payloads (UTF-8 of ``html_col``, null as empty) that are equal and have at least
    ``min_bytes``, the smallest id's is a response, the others are revisits without the
    payload; shorter ones are all responses. Rows that repeat both the smallest id and
    its payload are all responses, under one record id. A null id is never the
    smallest; where all ids of equal payloads are null, all are responses. Control
    characters and spaces of a URL are percent-encoded; a page without one has
    ``urn:page:<id>``. ``date`` is the WARC-Date of all records. No rows in: no records.

    A file has ``records_per_file`` records. Its dictionary is trained on its first
    ``sample_bytes`` of records, so a task holds little more than that, whatever its
    input; with too few records to train on, a file has no dictionary.
    """
    text = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        text.cast("binary").alias("payload"), F.sha2(text, 256).alias("digest"),
    )
    numbered = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    # as a table, so that the join below can shuffle both sides and split a hot payload
    shared = written(
        spark,
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(numbered).alias("first")).where("n > 1")
        .select(F.col("digest").alias("shared"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")),
        "shared-payloads",
    )
    placed = rows.join(shared, rows.digest == shared.shared, "left").select(
        "page_id", "url", "payload", "digest", "first_id", "first_url",
        (F.col("shared").isNotNull() & ~same(F.col("page_id"), F.col("first_id"))).alias("again"),
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(records_per_file, sample_bytes, dictionary_bytes, level)

        def made() -> Iterator[bytes]:
            for batch in text_chunks(batches, BATCH_BYTES, "payload"):
                for r in batch.to_pylist():
                    first = (r["first_id"], r["first_url"]) if r["again"] else None
                    yield from files.add(_record(r["page_id"], r["url"], r["payload"], r["digest"], first, date))
            yield from files.finish()

        return _batches(made())

    # bytes as they are: neither this cast nor the writer looks into a string
    lines = placed.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.options(
        lineSep=SEPARATOR, compression="none", maxRecordsPerFile=records_per_file + 1
    ).text(path)


def _unpacked(data: memoryview) -> Iterator[bytes]:
    """The records of one archive file."""
    import zstandard

    decompressor, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE_MAGIC:
            if magic == DICTIONARY_MAGIC and not at:
                raw = bytes(data[8 : 8 + size])
                if raw[:4] == struct.pack("<I", ZSTD_MAGIC):
                    raw = decompressor.decompress(raw)
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            at += 8 + size
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            step = data[at : at + STEP_BYTES]
            if not len(step):
                raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(step))
            at += len(step)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    length = int(fields["content-length"])
    block = rest[:length]
    if not head.startswith(b"WARC/1.") or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("a payload differs from its digest")
    page, first = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return (
        None if page is None else int(page), fields["warc-target-uri"], kind, fields["warc-record-id"],
        fields.get("warc-refers-to"), None if first is None else int(first), int(_fields(http)["content-length"]),
        digest, payload if kind == "response" else None, fields["warc-date"],
    )


RECORDS = (
    "page_id bigint, url string, record_type string, record_id string, refers_to_record string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary, date string"
)
_KINDS = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _KINDS[t]) for n, t in (f.split() for f in RECORDS.split(", "))])


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in ``path``, a row each: ``(page_id, url, record_type,
    record_id, refers_to_record, refers_to, payload_bytes, payload_digest, payload, date)``.

    Lengths and digests are verified; a damaged record fails the job. ``refers_to`` is the page
    id of a revisit's response. ``payload`` is null for revisits, and for all without ``payloads``;
    ``payload_bytes`` and ``payload_digest`` are those of the full payload. A task reads whole
    files; ``records_per_file`` of the writer bounds them.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in _unpacked(memoryview(content.as_buffer())):
                    row = _parsed(record)
                    rows.append(row if payloads else (*row[:8], None, row[9]))
                    size += len(record) if payloads else 500
                    if size >= BATCH_BYTES:
                        yield _made(rows)
                        rows, size = [], 0
                if rows:
                    yield _made(rows)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(unpack, RECORDS)


def _made(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)
