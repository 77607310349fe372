"""Writing and reading dictionary-compressed WARC archives (``.warc.zst``).

Every page becomes a record in a Zstandard frame of its own, compressed with a
dictionary trained on records. Each archive begins with a skippable frame that holds the
dictionary, so it can be read alone, and any record in it by its offset.

Pages with the same payload of ``min_revisit_bytes`` or more are written once: the one
with the largest page id is a ``response``, the others are ``revisit`` records with
the same headers and no payload. Who is what comes from digests alone, with map-side
combining; then the pages meet that small table in one join, which Spark splits
where one payload is hot. Short payloads never share a join key.

Files are written by tasks through the file system of the shared folder, each attempt
under a name of its own; the table of archives lists those of successful attempts
only, so a lost executor or a repeated task leaves no record twice.

The dictionary is trained on at most ``sample_records`` records of at most
``sample_bytes`` bytes, those with the smallest hash: a bound on what the driver sees,
not on what is archived. Too few records to train on are the dictionary themselves.

A null payload is empty. A page without an id cannot be referred to: alone
with its payload it is a response, otherwise a revisit. Rows that agree in id and payload
are all responses if one is.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import io
import struct
import uuid

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.common import stored
from sparkprep.session import scratch_path

# Fixed values of the two formats.
SKIPPABLE = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1_000
DATE = "2024-01-01T00:00:00Z"
DICTIONARY_BYTES = 112_640
SAMPLE_RECORDS = 600
SAMPLE_BYTES = 32_768
FILE_BYTES = 256 << 20
LEVEL = 3


def record_id(page_id: int | None, digest: str) -> str:
    """The id of a record, from what it archives."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None
) -> bytes:
    """One WARC record; a revisit if ``refers_to`` names the page that has the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    fields.append(("WARC-Payload-Digest", f"sha1:{coded}"))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary for records like these."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICTIONARY_BYTES:]


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that opens an archive; nothing if there is no dictionary."""
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


class ArchiveWriter:
    """Writes archives of a bounded size into a folder."""

    def __init__(self, folder: str, stem: str, dictionary: bytes) -> None:
        self.fs, self.folder = pa.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.uri, self.stem = folder, stem
        self.opening = dictionary_frame(dictionary)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)
        self.out, self.done = None, []

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"{self.stem}-{len(self.done):04d}.warc.zst"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self.out.write(self.opening)
            self.records = 0
        self.out.write(self.packer.compress(data))
        self.records += 1
        if self.out.tell() >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            size = self.out.tell()
            self.out.close()
            self.done.append((f"{self.uri}/{self.name}", self.records, size))
            self.out = None


def _write(folder: str, dictionary: bytes, batches):
    task = TaskContext.get()
    stem = f"part-{task.partitionId():05d}-{uuid.uuid4().hex[:12]}"
    writer = ArchiveWriter(folder, stem, dictionary)
    for batch in batches:
        names = batch.schema.names
        column = {n: batch.column(i) for i, n in enumerate(names)}
        for i in range(batch.num_rows):
            payload = column["payload"][i].as_py()
            writer.write(
                record(
                    column["page_id"][i].as_py(),
                    column["url"][i].as_py(),
                    (payload or "").encode("utf-8", "surrogatepass"),
                    column["digest"][i].as_py(),
                    column["size"][i].as_py(),
                    column["refers_to"][i].as_py(),
                )
            )
    writer.close()
    files, records, sizes = zip(*writer.done) if writer.done else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(files, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
        ["file", "records", "bytes"],
    )


def plan_records(df: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, size, refers_to`` from ``page_id, url, payload``.

    The payload of a revisit is null: it is not needed again.
    """
    body = F.coalesce(F.col("payload"), F.lit(""))
    sized = df.select("page_id", "url", "payload").withColumns(
        {"digest": F.sha1(body.cast("binary")), "size": F.octet_length(body).cast("bigint")}
    )
    owners = stored(
        sized.where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("owner"))
        .where("n > 1 and owner is not null")
        .select(F.col("digest").alias("_digest"), "owner"),
        "owners",
    )
    # A short payload looks up a key of its page's own, which cannot be there.
    own = F.concat(F.lit("-"), F.coalesce(F.col("page_id"), F.xxhash64("url", "payload")).cast("string"))
    key = F.when(F.col("size") >= min_revisit_bytes, F.col("digest")).otherwise(own)
    joined = sized.withColumn("_key", key).join(
        owners.hint("merge"), F.col("_key") == F.col("_digest"), "left"
    )
    refers = F.when(F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner"))
    planned = joined.withColumn("refers_to", refers)
    kept = F.when(F.col("refers_to").isNull(), F.col("payload"))
    return planned.select("page_id", "url", kept.alias("payload"), "digest", "size", "refers_to")


def sample_dictionary(df: DataFrame) -> bytes:
    """A dictionary from a bounded sample of the records of ``page_id, url, payload``."""
    body = F.coalesce(F.col("payload"), F.lit(""))
    draw = F.xxhash64("page_id", "url")
    # A hash keeps about twice the records needed, so no task returns more than its part.
    share = min(1.0, 2.0 * SAMPLE_RECORDS / max(1, df.count()))
    rows = (
        df.where(F.octet_length(body) <= SAMPLE_BYTES)
        .where(F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30)))
        .select("page_id", "url", body.alias("payload"))
        .orderBy(draw, "page_id", "url", "payload")
        .limit(SAMPLE_RECORDS)
        .collect()
    )
    records = []
    for r in rows:
        payload = r["payload"].encode("utf-8", "surrogatepass")
        digest = hashlib.sha1(payload).hexdigest()
        records.append(record(r["page_id"], r["url"], payload, digest, len(payload), None))
    return train_dictionary(records)


def write_archives(df: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``page_id, url, payload`` below the shared folder; returns ``file, records, bytes``."""
    folder = scratch_path(df.sparkSession, "warc")
    dictionary = sample_dictionary(df)
    planned = plan_records(df, min_revisit_bytes)
    written = planned.mapInArrow(
        functools.partial(_write, folder, dictionary), "file string, records bigint, bytes bigint"
    )
    return stored(written, "archives")


def records_of(stream):
    """``(fields, block)`` of every record of an archive, from an open binary stream."""
    source = io.BufferedReader(_Raw(stream))
    head = source.peek(8)[:8]
    data = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        (size,) = struct.unpack("<I", source.read(8)[4:])
        dictionary = source.read(size)
        if dictionary[:4] == ZSTD_FRAME:
            dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
        data = zstandard.ZstdCompressionDict(dictionary)
    plain = io.BufferedReader(
        zstandard.ZstdDecompressor(dict_data=data).stream_reader(source, read_across_frames=True)
    )
    while line := plain.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.lower()] = value.strip()
        block = plain.read(int(fields["content-length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


class _Raw(io.RawIOBase):
    """An Arrow input stream as a raw stream."""

    def __init__(self, stream) -> None:
        self.stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.stream.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def page_of(fields: dict, block: bytes) -> tuple:
    """``page_id, url, payload, bytes, digest, type, refers_to`` of a record, checked."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = next(
        int(line.partition(b":")[2])
        for line in head.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    )
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    number = [fields.get(k) for k in ("x-page-id", "x-refers-to-page-id")]
    page_id, refers_to = [int(n) if n is not None else None for n in number]
    text = payload.decode("utf-8", "surrogatepass") if kind == "response" else None
    return page_id, fields.get("warc-target-uri"), text, size, digest, kind, refers_to


_PAGE = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
]
_PAGE_SCHEMA = (
    "page_id bigint, url string, payload string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint"
)
READ_BYTES = 8 << 20


def _read(with_payload: bool, batches):
    for batch in batches:
        for file in batch.column(0).to_pylist():
            fs, path = pa.fs.FileSystem.from_uri(file)
            rows, held = [], 0
            with fs.open_input_stream(path) as stream:
                for fields, block in records_of(stream):
                    page = page_of(fields, block)
                    held += len(block) if with_payload else 200
                    rows.append(page if with_payload else (*page[:2], None, *page[3:]))
                    if held >= READ_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_PAGE)
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _PAGE)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in _PAGE])


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The pages in the archives of column ``file``; every payload is checked against its digest.

    ``payload`` is null for revisits, and for all without ``with_payload``.
    """
    files = archives.select("file")
    spread = files.repartition(max(1, min(files.count(), 10_000)), "file")
    return spread.mapInArrow(functools.partial(_read, with_payload), _PAGE_SCHEMA)
