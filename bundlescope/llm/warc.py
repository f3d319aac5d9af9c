"""Web archives: one Zstandard frame per WARC record, a dictionary in the leading frame.

An archive (``.warc.zst``) begins with a skippable frame that holds the dictionary of
all frames after it, raw or itself compressed; an archive too small to learn one from
begins with its first record. Each record is a frame of its own, so a reader can
begin at any frame's offset, and only one record is in memory at a time. Each write task
writes one archive under a name of its own; the table ``archives`` names those of
committed tasks, so a task that is run twice or lost leaves at most a file that nothing
names. The dictionary is learned from the first ``SAMPLE_BYTES`` (4 MB) of an archive's
own records; it only changes how small an archive is, never what is in it.

Pages are written as ``response`` records: an HTTP header and the payload. Of pages with
equal payloads (of at least ``min_bytes``) the one with the largest id is written so;
the others are ``revisit`` records with the HTTP header alone, which name the record
they refer to. Whole payloads are compared by their SHA-256.

The reader checks the frame's size against the record's, the version line, the named
fields a record must have, its ``Content-Length``, the line breaks that end it, the HTTP
``Content-Length``, and block and payload digests. What fails is an error that names
archive and offset; ``strict=False`` gives it as a row with ``problem`` instead. A bad
record in a sound frame does not keep the next ones from being read; after a damaged
frame, where the next one begins is not known, and the archive ends with it.

Nulls: a null html is an empty payload; a null url leaves ``WARC-Target-URI`` out; a page
without id is a record without ``Page-Id`` and refers to the group's largest id, if
any, else it is a response. Rows that repeat the largest id of their group are all
responses. A line break in a url is escaped. An empty table gives no archives. Other
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import stored, table
from bundlescope.llm.token_files import _file_system
from bundlescope.operators.joins import lookup_join
from bundlescope.session import scratch_path

SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MIN_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
# Fixed values of the formats: frame magic numbers, version line, revisit profile.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
_CHUNK, _PIECE, _FRAME_HEADER = 1 << 20, 1 << 14, 18
# Names of fields are the same in any case.
_NAMES = {
    name.lower(): name
    for name in (
        *NEEDED, "WARC-Target-URI", "WARC-Refers-To", "WARC-Profile", "WARC-Payload-Digest",
        "WARC-Block-Digest", "Content-Type", "Page-Id",
    )
}


class BadRecord(ValueError):
    """A frame or record that is not what its headers say."""


def digest_of(data: bytes) -> str:
    """The bare SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, so that a revisit can name it beforehand."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}").urn


def record(kind: str, named: dict[str, str], block: bytes, date: str = DATE) -> bytes:
    """A whole record in bytes, with its block digest and length."""
    fields = {"WARC-Type": kind, "WARC-Date": date} | named
    fields |= {"WARC-Block-Digest": f"sha1:{digest_of(block)}", "Content-Length": str(len(block))}
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items()), b"", block]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE
) -> bytes:
    """A page as a response, or as a revisit of the page whose payload it repeats."""
    digest = digest_of(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    named = {"WARC-Record-ID": f"<{record_id(page_id, digest)}>"}
    if page_id is not None:
        named["Page-Id"] = str(page_id)
    if url is not None:
        named["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    named |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}"}
    if refers_to is None:
        return record("response", named, head.encode() + payload, date)
    named |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": f"<{record_id(refers_to, digest)}>"}
    return record("revisit", named, head.encode(), date)


@dataclass
class Record:
    """What a reader makes of one frame."""

    fields: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    payload_bytes: int | None = None
    payload_digest: str | None = None

    @property
    def kind(self) -> str | None:
        return self.fields.get("WARC-Type")


def _named_fields(lines: list[bytes]) -> dict[str, str]:
    """Named fields; a line that begins with white space goes on with the one before it."""
    found: dict[str, str] = {}
    last = None
    for line in lines:
        text = line.decode("utf-8")
        if text[:1] in (" ", "\t") and last is not None:
            found[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon or not name or name != name.strip():
            raise BadRecord(f"not a named field: {text[:80]!r}")
        last = _NAMES.get(name.lower(), name)
        found[last] = value.strip()
    return found


def _length(fields: dict[str, str], name: str = "Content-Length") -> int:
    value = fields.get(name, "")
    if not (value.isascii() and value.isdigit()):
        raise BadRecord(f"{name} is not a number: {value!r}")
    return int(value)


def _checked_digest(fields: dict[str, str], name: str, data: bytes) -> None:
    said = fields.get(name)
    if said is not None and said.startswith("sha1:") and said != f"sha1:{digest_of(data)}":
        raise BadRecord(f"{name} does not match")


def parsed(data: bytes) -> Record:
    """The record that fills these bytes from end to end, checked."""
    head, split, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not split or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadRecord("no WARC version line and header")
    fields = _named_fields(lines[1:])
    missing = [name for name in NEEDED if not fields.get(name)]
    if missing:
        raise BadRecord(f"without {', '.join(missing)}")
    length = _length(fields)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadRecord(f"a block of {length} bytes is said, {len(rest) - 4} are there")
    block = rest[:length]
    _checked_digest(fields, "WARC-Block-Digest", block)
    if not fields.get("Content-Type", "").startswith("application/http"):
        return Record(fields, block, len(block), fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"))
    http, split, payload = block.partition(b"\r\n\r\n")
    status, *http_lines = http.split(b"\r\n")
    if not split or not status.startswith(b"HTTP/"):
        raise BadRecord("no HTTP header in the block")
    said = _length(_named_fields(http_lines))
    if fields["WARC-Type"] == "revisit":
        if not fields.get("WARC-Refers-To") or payload:
            raise BadRecord("a revisit without WARC-Refers-To, or with a payload")
        return Record(fields, None, said, fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"))
    if said != len(payload):
        raise BadRecord(f"a payload of {said} bytes is said, {len(payload)} are there")
    _checked_digest(fields, "WARC-Payload-Digest", payload)
    return Record(fields, payload, said, digest_of(payload))


def learned(samples: list[bytes]):
    """A dictionary, or None where there is too little to learn one from."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL) if len(samples) > 7 else None
    except zstandard.ZstdError:
        return None


def _compressor(dictionary):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)


def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame that carries the dictionary, itself compressed."""
    body = _compressor(None).compress(dictionary)
    return SKIPPABLE_MAGIC.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body


class _Frames:
    """The frames of a byte stream, read forward in pieces."""

    def __init__(self, stream):
        self.stream, self.held, self.at, self.offset = stream, b"", 0, 0

    def _has(self, least: int) -> bool:
        """Whether so many more bytes are there; they are held then."""
        while len(self.held) - self.at < least:
            data = self.stream.read(_CHUNK)
            if not data:
                return False
            self.held, self.at = self.held[self.at :] + data, 0
        return True

    def _peek(self, count: int) -> bytes:
        self._has(count)
        return self.held[self.at : self.at + count]

    def _move(self, count: int) -> None:
        self.at += count
        self.offset += count

    def _skippable(self) -> bytes | None:
        """The next frame's content if it is one that decoders skip."""
        head = self._peek(8)
        if len(head) < 8 or int.from_bytes(head[:4], "little") & ~15 != SKIPPABLE_MAGIC & ~15:
            return None
        size = 8 + int.from_bytes(head[4:], "little")
        whole = self._peek(size)
        if len(whole) < size:
            raise BadRecord(f"a skippable frame ends before its {size - 8} bytes")
        self._move(size)
        return whole[8:]

    def dictionary(self):
        """What the leading frame holds if it is the dictionary's, else None."""
        import zstandard

        if self._peek(4) != SKIPPABLE_MAGIC.to_bytes(4, "little"):
            return None
        body = self._skippable()
        if body is None:
            raise BadRecord("the leading frame ends within its header")
        if body[:4] == FRAME_MAGIC.to_bytes(4, "little"):
            body = zstandard.ZstdDecompressor().decompress(body)
        return zstandard.ZstdCompressionDict(body)

    def records(self) -> Iterator[tuple[int, bytes]]:
        """Offset and content of each frame."""
        import zstandard

        known = self.dictionary()
        reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
        while self._has(1):
            if self._skippable() is not None:
                continue
            start, out, one = self.offset, [], reader.decompressobj()
            size = zstandard.frame_content_size(self._peek(_FRAME_HEADER))
            while not one.eof:
                data = self._peek(_PIECE)
                if not data:
                    raise BadRecord("the archive ends within a frame")
                out.append(one.decompress(data))
                self._move(len(data) - len(one.unused_data))
            whole = b"".join(out)
            if size not in (-1, len(whole)):
                raise BadRecord(f"a frame of {size} bytes is said, {len(whole)} are there")
            yield start, whole


def read_archive(stream) -> Iterator[tuple[int, Record | BadRecord]]:
    """Offset and record, or what is wrong with it, of every frame of an archive."""
    import zstandard

    frames = _Frames(stream)
    try:
        for at, data in frames.records():
            try:
                found = parsed(data)
            except (BadRecord, UnicodeDecodeError) as error:
                found = BadRecord(str(error))
            yield at, found
    except (BadRecord, zstandard.ZstdError) as error:  # where the next frame begins is not known
        yield frames.offset, BadRecord(str(error))


_ARCHIVE = "name string, records bigint, bytes bigint, dictionary boolean"
_ARCHIVE_ARROW = pa.schema(
    [("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("dictionary", pa.bool_())]
)


def grouped_payloads(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, and ``refers_to``, the largest page id with the payload, if another.

    Payload digests are grouped, not payloads, and only payloads that occur twice are
    looked up: by broadcast if they measure small, else by a join that splits hot ones.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("key"),
    )
    twice = rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("key").alias("_key")).agg(
        F.max("page_id").alias("top"), F.count(F.lit(1)).alias("rows")
    )
    groups = stored(twice.where("rows > 1").select("_key", "top"), "payload-groups")
    joined = lookup_join(rows, groups, "key", "_key")
    other = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("top")).alias("refers_to"))


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """page_id, url and html as archives, one per task, and the table ``archives``."""

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, n_records = f"{uuid.uuid4().hex}.warc.zst", 0
        rows = (
            page_record(*row, date)
            for batch in batches
            for k in range(0, batch.num_rows, 64)
            for row in zip(*(c.to_pylist() for c in batch.slice(k, 64).columns))
        )
        samples, held = [], 0
        for data in rows:
            samples.append(data)
            held += len(data)
            if held >= SAMPLE_BYTES:
                break
        if not samples:
            return
        system, path = _file_system(folder)
        system.create_dir(path, recursive=True)
        dictionary = learned([s[: SAMPLE_BYTES // 8] for s in samples])
        one = _compressor(dictionary)
        with system.open_output_stream(f"{path}/{name}", compression=None) as out:
            if dictionary:
                out.write(leading_frame(dictionary.as_bytes()))
            for source in (samples, rows):
                for data in source:
                    out.write(one.compress(data))
                    n_records += 1
            size = out.tell()
        yield table(_ARCHIVE_ARROW, [[name], [n_records], [size], [dictionary is not None]])

    grouped_payloads(pages, min_bytes).mapInArrow(archive, _ARCHIVE).write.parquet(f"{folder}/archives")


_RECORD = (
    "archive string, offset bigint, record_id string, record_type string, target_uri string, date string, "
    "refers_to_id string, fields map<string,string>, payload binary, payload_bytes bigint, "
    "payload_digest string, problem string"
)
_RECORD_ARROW = pa.schema(
    [
        ("archive", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
        ("target_uri", pa.string()), ("date", pa.string()), ("refers_to_id", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("problem", pa.string()),
    ]
)


def _row(name: str, at: int, found: Record | BadRecord) -> tuple:
    if isinstance(found, BadRecord):
        return (name, at, *[None] * 9, str(found))
    get = found.fields.get
    return (
        name, at, get("WARC-Record-ID"), found.kind, get("WARC-Target-URI"), get("WARC-Date"),
        get("WARC-Refers-To"), list(found.fields.items()), found.payload, found.payload_bytes,
        found.payload_digest, None,
    )


def read_archives(
    spark: SparkSession, folder: str, names: list[str], payloads: bool = True, strict: bool = True
) -> DataFrame:
    """Every record of the named archives of a folder, each archive read by one task.

    ``payloads=False`` checks payloads all the same but does not return them.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        for name in (names[n] for batch in batches for n in batch.column(0).to_pylist()):
            with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                rows, held = [], 0
                for at, found in read_archive(stream):
                    if isinstance(found, BadRecord) and strict:
                        raise ValueError(f"{name} at {at}: {found}")
                    if isinstance(found, Record):
                        held += len(found.payload or b"") if payloads else 0
                        found.payload = found.payload if payloads else None
                    rows.append(_row(name, at, found))
                    held += 1024
                    if held >= _CHUNK:
                        yield table(_RECORD_ARROW, list(zip(*rows)))
                        rows, held = [], 0
                if rows:
                    yield table(_RECORD_ARROW, list(zip(*rows)))

    return spark.range(0, len(names), 1, max(1, len(names))).mapInArrow(records, _RECORD)


def read(spark: SparkSession, folder: str, payloads: bool = True, strict: bool = True) -> DataFrame:
    """Every record of the archives that ``write`` made.

    The driver sees the names of archives, no more than there were write tasks.
    """
    found = spark.read.schema(_ARCHIVE).parquet(f"{folder}/archives").select("name").orderBy("name")
    return read_archives(spark, folder, [r.name for r in found.collect()], payloads, strict)


def with_referred_page(records: DataFrame) -> DataFrame:
    """page_id and ``refers_to``, the page id of the record that a revisit names.

    Only ids move. The records named are few for many revisits, so they are looked up
    by broadcast if they measure small, else by a join that splits hot ones. A revisit
    whose record is not there, or has another payload digest, keeps a null.
    """
    page = F.col("fields")["Page-Id"].cast("bigint")
    rows = records.select(*[c for c in records.columns if c != "fields"], page.alias("page_id"))
    asked = rows.where("record_type = 'revisit'").select(F.col("refers_to_id").alias("_asked")).distinct()
    targets = (
        rows.where("record_type = 'response'")
        .join(asked, F.col("record_id") == F.col("_asked"), "left_semi")
        .groupBy(F.col("record_id").alias("_id"))
        .agg(F.max("page_id").alias("_page"), F.max("payload_digest").alias("_digest"))
    )
    joined = lookup_join(rows, stored(targets, "warc-targets"), "refers_to_id", "_id")
    refers_to = F.when(F.col("payload_digest") == F.col("_digest"), F.col("_page"))
    return joined.select(*rows.columns, refers_to.alias("refers_to"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as archives, read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = scratch_path(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records = stored(read(spark, folder, payloads=False).drop("payload"), "warc-records")
    return with_referred_page(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP12_SQL = f"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('{_BASE32}',
    CAST(((CAST('0x' || substr(h, CAST(k // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> (15 - k % 4 * 5)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN top IS DISTINCT FROM page_id AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top IS DISTINCT FROM page_id THEN top END AS refers_to
FROM p
"""
