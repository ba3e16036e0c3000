"""WARC archives, each record compressed on its own against a shared Zstandard dictionary.

The dictionary is built from a bounded sample of the records themselves and stands at
the head of each archive in a skippable frame (magic 0x184D2A5D), so an archive can be
read alone. Then comes one Zstandard frame per record, which a reader can begin at.

Every page is a record: a ``response`` with the HTTP head and the payload, or, where a
page with a smaller id has the same payload of at least ``MIN_PAYLOAD`` bytes, a
``revisit`` with the HTTP head only that refers to it. Digests that occur once never
leave their task in the search for copies; the first page of a digest is an aggregate
with a map-side part, and the join of a digest with very many pages is split by Spark.

Tasks write archives of bounded size to a folder that all executors share, under a
temporary name, then rename; a task that runs again writes the same file again. The
manifest (path, records, bytes) is what reading starts from.

Defined results: NULL html is an empty payload; payloads below the least size are all
responses; rows of equal page_id and payload are equal records, both responses where
the id is the smallest; a row without a page_id counts as last and is never referred
to; NULL url is written as an empty target; an empty table writes nothing.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import NO_ID, Stash, bounded, id_key, id_of, scratch

MIN_PAYLOAD = 100
SKIPPABLE = 0x184D2A5D
DICTIONARY_BYTES = 112_640
SAMPLE_ROWS = 1000
SAMPLE_BYTES = 65_536
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    block = head if refers_to is not None else head + html
    target = "".join(c for c in url or "" if c not in "\r\n")
    name = "none" if page_id is None else page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record; ``payload`` is None for a revisit, whose size and digest are those its head names.

    A response whose payload has another size or digest than its head says is refused.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(fields["Content-Length"])
    block, end = rest[:length], rest[length:]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError(f"the block of {fields['WARC-Record-ID']} has another length than its head says")

    def page(field: str) -> int | None:
        name = fields.get(field, "<urn:page:none>")[len("<urn:page:") : -1]
        return None if name == "none" else int(name)

    revisit = fields["WARC-Type"] == "revisit"
    if not revisit:
        # What is reported is measured on the payload that was read.
        measured = len(payload), hashlib.sha256(payload).hexdigest()
        if measured != (size, digest):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not the one that was written")
        size, digest = measured
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": page("WARC-Refers-To") if revisit else None,
        "payload": None if revisit else payload,
    }


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on records; where they are too few or too small to train on, their own bytes."""
    total = sum(map(len, records))
    try:
        return zstandard.train_dictionary(min(size, max(total // 8, 256)), records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:size] or b"WARC/1.1\r\n"


def frame_of(dictionary: bytes) -> bytes:
    """The skippable frame that carries the dictionary."""
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


class Writer:
    """Writes one archive after the other, each below a size, under final names only when whole."""

    def __init__(self, folder: str, name: str, dictionary: bytes, level: int = LEVEL, limit: int = ARCHIVE_BYTES):
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.uri, self.name, self.limit = folder, name, limit
        self.head = frame_of(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        self.number, self.file, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.file is None:
            self.temporary = f"{self.folder}/.{self.name}-{self.number:05d}-{uuid.uuid4().hex}"
            self.file = self.system.open_output_stream(self.temporary, compression=None)
            self.file.write(self.head)
            self.size, self.records = len(self.head), 0
        frame = self.compressor.compress(data)
        self.file.write(frame)
        self.size += len(frame)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            final = f"{self.name}-{self.number:05d}.warc.zst"
            if self.system.get_file_info(f"{self.folder}/{final}").type != fs.FileType.NotFound:
                self.system.delete_file(f"{self.folder}/{final}")  # of an attempt that was lost
            self.system.move(self.temporary, f"{self.folder}/{final}")
            self.done.append((f"{self.uri}/{final}", self.records, self.size))
            self.number, self.file = self.number + 1, None


_MANIFEST = "path string, records long, bytes long"


def _archiver(folder: str, dictionary: bytes, level: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = Writer(folder, f"part-{TaskContext.get().partitionId():05d}", dictionary, level, limit)
        for batch in batches:
            for row in batch.to_pylist():
                page = None if row["page"] == NO_ID else row["page"]
                writer.add(record(page, row["url"], row["html"], row["digest"], row["refers_to"]))
        writer.close()
        paths, records, sizes = zip(*writer.done, strict=True) if writer.done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            names=["path", "records", "bytes"],
        )

    return run


def write_archives(
    pages: DataFrame, folder: str | None = None, level: int = LEVEL, archive_bytes: int = ARCHIVE_BYTES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Write one record per page; the manifest of the archives comes back, stored.

    ``folder`` is a URI that all executors reach (a fresh one in the shared folder by default).
    """
    spark = pages.sparkSession
    stash = Stash(spark)
    folder = folder or scratch(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    payload = F.coalesce(F.encode(F.col("html"), "utf-8"), F.lit(b"").cast("binary"))
    shaped = pages.select(id_key("page_id").alias("page"), "url", payload.alias("html")).withColumn(
        "digest", F.sha2("html", 256)
    )
    large = F.octet_length("html") >= MIN_PAYLOAD
    copies = stash.put(
        shaped.where(large)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("of"), "first"),
        "copies",
    )
    refers = F.when(F.col("page") != F.col("first"), id_of("first")).alias("refers_to")
    placed = shaped.join(copies, shaped["digest"] == copies["of"], "left").select("page", "url", "html", "digest", refers)
    # Bounded in rows and in bytes of each; it only shapes the dictionary.
    sample = shaped.select("page", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"), "digest")
    sample = bounded(sample, sample_rows, pages.count(), "page", "digest").collect()
    dictionary = build_dictionary(
        [record(None if r["page"] == NO_ID else r["page"], r["url"], bytes(r["html"]), r["digest"], None) for r in sample]
    )
    return stash.put(placed.mapInArrow(_archiver(folder, dictionary, level, archive_bytes), _MANIFEST), "manifest")


def records_in(uri: str, chunk: int = 1 << 20) -> Iterator[dict]:
    """The records of one archive, in order, read as a stream."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path, compression=None) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != SKIPPABLE:
            raise ValueError("the archive does not begin with a dictionary")
        dictionary = zstandard.ZstdCompressionDict(file.read(size))
        decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
        left = b""
        while True:
            data = left or file.read(chunk)
            if not data:
                return
            frame, parts = decompressor.decompressobj(), []
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    break
                data = file.read(chunk)
                if not data:
                    raise ValueError("the archive ends within a record")
            left = frame.unused_data
            yield parse(b"".join(parts))


_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _reader(with_payload: bool):
    kinds = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ] + [("payload", pa.binary())] * with_payload
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in records_in(path):
                    size += len(row["payload"] or b"")
                    rows.append({name: row[name] for name, _ in kinds})
                    if size > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives that a manifest lists, an archive per task.

    There are as many ranges of paths as archives, so no two share a task and nothing
    merges the tasks, however few bytes the paths themselves have.
    """
    archives = max(manifest.count(), 1)
    spread = manifest.select("path").repartitionByRange(archives, "path")
    return spread.mapInArrow(_reader(with_payload), _RECORD + ", payload binary" * with_payload)
