"""Web archives of pages: a compressed record per page under a dictionary, and the reader that gives the pages back.

1. Payloads of at least ``least_bytes`` are grouped by SHA-256. Of a group, the record with the least page_id holds the payload
   (``response``), the others point to it (``revisit``).
2. A Zstandard dictionary is trained on a bounded, repeatable draw of the records.
3. Each task writes an archive: a skippable frame that holds the dictionary, then a frame per record. Archives are written by Spark's own text
   writer, which commits files as a whole and reaches any store: a row is a frame, and the line separator an empty skippable frame, which
   readers pass over.
4. The reader takes the dictionary from the archive's first frame, walks the frames and parses the records.

A payload that a thousandth of all pages or more have is looked up by broadcast (at most 1,000 such), so no copies of it meet in one
task; the other pages move once, by digest, unless the repeated payloads are few enough for Catalyst to broadcast them.

Archives are as large as the partitions of written records, which ``spark.sql.files.maxPartitionBytes`` bounds, so that the reader
can hold one.

Defined cases: a null html is an empty payload; a null page_id is no least id and is not recorded: its record is a revisit
if the payload has a response, else a response; repeated rows of the least id are all responses; a null url is recorded as
``urn:page:`` and the id, and control characters and spaces in a url are percent-encoded; where the draw is too small to train on, archives
have no dictionary and no leading frame; an empty table gives no archives and an empty result; other columns stay out of the work. Ids
must fit a long.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import as_batch, doc_draw
from footfall.llm.words import slices
from footfall.session import materialise, scratch_path

# Numbers of the Zstandard and archive formats.
FRAME, SKIPPABLE, DICTIONARY_FRAME, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# End of fixed values.
#: An empty skippable frame; ASCII, so that it can stand between rows of a text table.
BETWEEN = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
#: Bytes of records that a worker holds at a time.
SLICE = 4_000_000


@dataclass(frozen=True)
class Settings:
    """``train_rows`` and ``train_bytes`` bound the records that the dictionary is trained on, ``dictionary_bytes`` its size."""

    least_bytes: int = 100
    level: int = 3
    train_rows: int = 1_000
    train_bytes: int = 8_000_000
    dictionary_bytes: int = 64_000
    date: str = "1970-01-01T00:00:00Z"


def records(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(page_id, url, payload, size, digest, first, first_url): each page with its payload and, if it is a revisit, the response's id.

    Writes the repeated payloads' digests while it is built. A revisit's payload is null.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("size"), F.sha2(F.col("payload"), 256).alias("digest")
    )
    groups = rows.where(F.col("size") >= settings.least_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url")
    )
    repeated = materialise(groups.where((F.col("copies") > 1) & F.col("first").isNotNull()), "repeated")
    # at most a thousand payloads have a thousandth of the rows each
    hot = repeated.where(F.col("copies") * 1000 >= pages.agg(F.count(F.lit(1))).scalar()).select("digest", "first", "first_url")
    cold = repeated.join(F.broadcast(hot.select("digest")), "digest", "left_anti").select("digest", "first", "first_url")
    found = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    found = found.withColumn("payload", F.when(~again, F.col("payload")))
    # settled and short payloads, which may be many alike, have a key of their own that nothing matches
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    key = F.when(F.col("hot").isNotNull() | (F.col("size") < settings.least_bytes), own).otherwise(F.col("digest"))
    looked_up = found.withColumn("key", key).join(
        cold.select(F.col("digest").alias("key"), F.col("first").alias("cold_first"), F.col("first_url").alias("cold_url")), "key", "left"
    ).withColumns({
        "first": F.coalesce("first", "cold_first"),
        "first_url": F.when(F.col("hot").isNotNull(), F.col("first_url")).otherwise(F.col("cold_url")),
    })
    return looked_up.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "digest",
        F.when(again, F.col("first")).alias("first"), F.when(again, F.col("first_url")).alias("first_url"),
    )


def _record_id(kind: str, page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{kind}|{page_id}|{digest}'.encode()).hexdigest())}>"


def _uri(url: str | None, page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}" if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *[f"{name}: {value}" for name, value in fields if value is not None]]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(row: dict, date: str) -> bytes:
    """A whole WARC record of a row of :func:`records`."""
    kind = "response" if row["first"] is None else "revisit"
    payload = (row["payload"] or "").encode() if kind == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    fields: list[tuple[str, object]] = [
        ("WARC-Type", kind), ("WARC-Record-ID", _record_id(kind, row["page_id"], row["digest"])), ("WARC-Date", date),
        ("WARC-Target-URI", _uri(row["url"], row["page_id"])), ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id("response", row["first"], row["digest"])),
            ("WARC-Refers-To-Target-URI", _uri(row["first_url"], row["first"])), ("Refers-To-Page-ID", row["first"]),
        ]
    fields += [
        ("Page-ID", row["page_id"]), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(http) + len(payload)),
    ]
    return _head(fields) + http + payload + b"\r\n\r\n"


def train(rows: DataFrame, settings: Settings = Settings()) -> bytes:
    """A dictionary from about ``train_rows`` records and ``train_bytes`` bytes of the archive, drawn by the hash of page_id.

    Records above a sixteenth of the bytes stay out of the draw. Empty where there is too little to train on.
    """
    fit = rows.where(F.col("payload").isNotNull() & (F.col("size") <= settings.train_bytes // 16))
    n, size = fit.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = min(1.0, settings.train_rows / max(n, 1), settings.train_bytes / max(size, 1))
    drawn = fit.where(doc_draw("warc", F.col("page_id")) < share).drop("first", "first_url")
    samples = [record({**r.asDict(), "first": None}, settings.date) for r in drawn.orderBy("page_id", "digest").collect()]
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _written(dictionary: bytes, settings: Settings):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=settings.level, dict_data=known, write_checksum=True, write_content_size=True)
        schema = pa.schema([("frame", pa.binary())])
        lead = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary] if dictionary else []
        for piece in slices(batches, "payload", SLICE):
            if lead is not None:
                info = b"software: footfall\r\nformat: WARC File Format 1.1\r\n"
                head = _head([
                    ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("warcinfo", None, "")), ("WARC-Date", settings.date),
                    ("Content-Type", "application/warc-fields"), ("Content-Length", len(info)),
                ])
                yield as_batch(schema, [[*lead, writer.compress(head + info + b"\r\n\r\n")]])
                lead = None
            yield as_batch(schema, [[writer.compress(record(row, settings.date)) for row in piece.to_pylist()]])

    return write


def write(pages: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """Archives of the pages in a folder that does not exist yet. Writes their records beside it first."""
    rows = materialise(records(pages, settings), "records")
    dictionary = train(rows, settings)
    frames = rows.mapInArrow(_written(dictionary, settings), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", BETWEEN).text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its headers."""
    magic, size = struct.unpack_from("<II", data, at)
    if magic & 0xFFFFFFF0 == SKIPPABLE:
        return at + 8 + size
    if magic != FRAME:
        raise ValueError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    content = (1 if single else 0, 2, 4, 8)[flags >> 6]
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + content
    last = 0
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last = block & 1
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
    return at + (4 if flags >> 2 & 1 else 0)


def frames(data: bytes) -> Iterator[bytes]:
    """The decompressed frames of an archive in order, its own dictionary used."""
    view, at, known = memoryview(data), 0, None
    reader = zstandard.ZstdDecompressor()
    while at < len(view):
        end = frame_end(view, at)
        magic = struct.unpack_from("<I", view, at)[0]
        if at == 0 and magic == DICTIONARY_FRAME:
            known = bytes(view[8:end])
            if struct.unpack_from("<I", known)[0] == FRAME:  # a dictionary may itself be compressed
                known = reader.decompressobj().decompress(known)
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known))
        elif magic == FRAME:
            yield reader.decompressobj().decompress(view[at:end])
        at = end


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by name in small letters, block) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


READ = (
    "page_id long, url string, html string, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in READ.split(", ")])
    number = lambda text: None if text is None else int(text)
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for data in frames(content.as_py()):
                fields, block = parse(data)
                kind = fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                recorded = fields["warc-payload-digest"].removeprefix("sha256:")
                size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
                if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, recorded):
                    raise ValueError(f"the payload of {fields['warc-record-id']} is not what its header says")
                rows.append((
                    number(fields.get("page-id")), fields["warc-target-uri"], payload.decode() if kind == "response" else None,
                    size, recorded, kind, number(fields.get("refers-to-page-id")),
                ))
                held += len(data)
                if held > SLICE:
                    yield as_batch(schema, list(map(list, zip(*rows))))
                    rows, held = [], 0
            if rows:
                yield as_batch(schema, list(map(list, zip(*rows))))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder of archives: payloads of responses are checked against their digests; a revisit has no html."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, READ)


def round_trip(pages: DataFrame, settings: Settings = Settings(), path: str | None = None) -> DataFrame:
    """The pages archived under ``path``, or the run's folder, and read back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archive")
    write(pages, path, settings)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
