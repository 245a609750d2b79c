"""WARC archives of individually compressed records that share one dictionary.

An archive starts with a skippable frame that holds a Zstandard dictionary,
trained on archived records. Every record follows as a frame of its own,
compressed with that dictionary, so that a record can be read alone and even a
small one compresses well.

Of records with equal payloads (of at least ``min_bytes``) the one with the
smallest page id is the response; the others become revisits that refer to it
and carry no payload. Who is who comes from a grouped minimum over payload
digests and a join, so no group meets in one task.

Each task writes archives of bounded size under a name of its attempt and
renames them when they are whole. A repeated attempt writes the same names, so
an archive exists once. Reading goes archive by archive.

Defined cases: a null payload is an empty one. Equal rows are records of their
own, of which one is the response. A null page id ranks last. An empty table
gives no archive and an empty result. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace, importable

# Fixed values of the archive format.
SKIPPABLE_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"

DICTIONARY_BYTES = 65_536
# The dictionary is trained on about so many records, the first SAMPLE_BYTES of each.
SAMPLE_RECORDS = 1_000
SAMPLE_BYTES = 32_768
# A task starts a new archive beyond this size.
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"

READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def filesystem(uri: str):
    """(file system, path) of a folder that Spark's writers and this one share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def roles(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Adds ``is_revisit``, ``refers_to`` and ``refers_row``; in: row, page_id, payload.

    Both sides of the join read ``row``, so it must come from a written table.
    """
    keyed = pages.select("*", F.unhex(F.sha1("payload")).alias("sha1"), F.length("payload").alias("size"))
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    first = (
        keyed.filter(F.col("size") >= min_bytes)
        .groupBy("sha1", F.xxhash64("sha1").alias("_spread"))
        .agg(F.min(rank).alias("first"))
        .drop("_spread")
    )
    met = keyed.join(first, "sha1", "left").withColumn("is_revisit", F.coalesce(F.col("first.row") != F.col("row"), F.lit(False)))
    return met.select(
        "row", "page_id", "url", "payload", "sha1", "is_revisit",
        F.when(F.col("is_revisit"), F.col("first.page_id")).alias("refers_to"),
        F.when(F.col("is_revisit"), F.col("first.row")).alias("refers_row"),
    )


def train_dictionary(pages: DataFrame, dictionary_bytes: int, sample_records: int) -> bytes:
    """A dictionary from a bounded sample, trained in one task; empty if there is too little to learn from."""
    rows = pages.count()
    if not rows:
        return b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        samples = [x for b in batches for x in b.column(0).to_pylist() if x]
        try:
            found = zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
        except zstandard.ZstdError:
            found = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([found], pa.binary())})

    share = min(1.0, 2 * sample_records / rows)
    sample = pages.sample(share, seed=3).select(F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))
    return bytes(sample.limit(sample_records).coalesce(1).mapInArrow(run, "dictionary binary").first()[0])


def record_id(page_id: int | None, row: int) -> str:
    """A record's own name: page ids may be null or repeat, the row number does not."""
    return f"<{RECORD_ID}{'' if page_id is None else page_id}:{row}>"


def record(
    row: int, page_id: int | None, url: str | None, payload: bytes, sha1: bytes,
    revisit: bool, refers_to: int | None, refers_row: int | None,
) -> bytes:
    digest = base64.b32encode(sha1).decode()
    body = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, row)),
        ("WARC-Date", DATE),
        *([] if url is None else [("WARC-Target-URI", "".join(" " if c in "\r\n" else c for c in url))]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, refers_row))] if revisit else []),
        ("Content-Type", "application/octet-stream"),
        ("Content-Length", str(len(body))),
    ]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """The row of a record; ValueError where its parts contradict each other."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    if lines[0] != VERSION or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["X-Payload-Length"])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")

    def number(name: str) -> int | None:
        text = fields.get(name, "").strip("<>").removeprefix(RECORD_ID).partition(":")[0]
        return int(text) if text else None

    return (
        number("WARC-Record-ID"), fields.get("WARC-Target-URI"), kind, number("WARC-Refers-To"),
        size, digest, body if kind == "response" else None,
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    dictionary: bytes,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes the rows of ``roles`` as archives into ``folder``; one row per archive: path, records.

    The archives exist once the result has been computed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        context = TaskContext.get()
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=6, dict_data=shared, write_content_size=True)
        done: list[tuple[str, int]] = []
        buffer, count = io.BytesIO(), 0

        def close() -> None:
            nonlocal buffer, count
            name = f"{root}/part-{context.partitionId():05d}-{len(done):04d}.warc.zst"
            draft = f"{name}.{context.taskAttemptId()}.tmp"
            with files.open_output_stream(draft, compression=None) as out:
                out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary)
                out.write(buffer.getbuffer())
            files.move(draft, name)
            done.append((name, count))
            buffer, count = io.BytesIO(), 0

        for batch in batches:
            names = ("row", "page_id", "url", "payload", "sha1", "is_revisit", "refers_to", "refers_row")
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            for values in zip(*columns):
                buffer.write(compressor.compress(record(*(v.as_py() for v in values))))
                count += 1
                if buffer.tell() >= archive_bytes:
                    close()
        if count:
            close()
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array([p for p, _ in done], pa.string()), "records": pa.array([n for _, n in done], pa.int64())}
        )

    importable(pages.sparkSession)
    # In one order, so that a repeated attempt cuts the same archives.
    return pages.sortWithinPartitions("sha1", "row").mapInArrow(run, "path string, records bigint")


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of one archive in order."""
    import zstandard

    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no dictionary frame")
    dictionary = data[8 : 8 + size]
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    rest = memoryview(data)[8 + size :]
    while len(rest):
        reader = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        out = reader.decompress(rest)
        yield out
        rest = rest[len(rest) - len(reader.unused_data) :]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in ``folder``; a revisit has no payload."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archives in batches:
            for content in archives.column(0):
                rows: list[tuple] = []
                for data in records_of(content.as_py()):
                    rows.append(parse(data))
                    if len(rows) >= 500:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    importable(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return found.select("content").mapInArrow(run, READ)


def archive(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    dictionary_bytes: int = DICTIONARY_BYTES,
    sample_records: int = SAMPLE_RECORDS,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archives ``pages`` into ``folder`` and returns what the archives hold, read back."""
    spark = pages.sparkSession
    importable(spark)
    work = Workspace(spark)
    folder = folder or work.path("archives")
    numbered = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(html, F.lit("")), "UTF-8").alias("payload"),
    )
    # Row numbers are drawn once: computed again over another order they would name other rows.
    rows = work.write(numbered, "rows")
    dictionary = train_dictionary(rows, dictionary_bytes, sample_records)
    written = work.write(write_archives(roles(rows, min_bytes), folder, dictionary, archive_bytes), "written")
    work.drop("rows")
    if not written.agg(F.sum("records")).first()[0]:
        return spark.createDataFrame([], READ)
    return read_archives(spark, folder)
