"""Pages as WARC archives: written as whole-file gzip, normalised to one gzip member per record with a
sidecar offset index, and read back record by record.

A monolithic archive is one gzip stream over all its records, so no record can be reached without
inflating everything before it. ``normalise`` inflates each such file once, as a stream, cuts it at the
records' own lengths and writes every record as a gzip member of its own; beside the archive it writes
``<archive>.cdxj``, one JSON line per record with the offset and length of its member. From then on a
record is one ranged read, and splits of the index are the units of work.

- Archives are written by Spark's text writer: a row is a record, the line separator is the blank lines
  that end a record, the codec is gzip. Only copies are shuffled: rows whose payload surely occurs once,
  by a bitmap of fixed size over the digests of repeated payloads, go from the scan to the archive.
- Normalising holds a chunk of a file, never a file or a record. Output names follow from input names
  and the bytes from the input, and a file appears under its name by a rename when it is complete, so a
  task that runs again after a lost executor replaces its own work. Members and the sidecar are written
  through ``pyarrow.fs``: the folder (below ``spark.checkpoint.dir``) must be a store it knows, such as
  a shared mount, HDFS or an object store.
- Bodies: a ``response`` holds an HTTP head and the payload; a ``revisit`` holds no payload but the
  digest and length of the one it repeats, and the record that has it.

Defined results:

- A null html is an empty payload; a null url gives the target ``urn:page:<page_id>``. Control
  characters and blanks in a url are written percent-encoded. A null page_id is written as ``none``.
- Payloads of at least ``REVISIT_BYTES`` bytes that are equal (by SHA-256): every row with the smallest
  page_id is a response, repeated rows included, and the rows of other page_ids revisit it, those with
  a null page_id too. Where all page_ids are null, all are responses.
- Files that are gzipped member by member, or hold blank lines between records, are normalised too; a
  file that ends within a record, or a member whose payload does not match its digest, is an error.
- An empty table gives archives without records, and no rows. Columns beyond page_id, url and html are
  not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm import common

#: Fixed values of the WARC format and of the records written here.
VERSION = "WARC/1.1"
LINE_END, RECORD_END = "\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http;msgtype=response"
HTTP_STATUS = "HTTP/1.1 200 OK"
HTML_TYPE = "text/html; charset=utf-8"
NO_ID = "none"
#: The table has no capture times: a parameter says what is written.
CAPTURED = "1970-01-01T00:00:00Z"
#: Payloads from this size on are stored once.
REVISIT_BYTES = 100
#: Bytes read, inflated or written at once.
CHUNK = 1 << 20
#: A record head longer than this is no record head.
LONGEST_HEAD = 1 << 20
GZIP_LEVEL = 6

INDEX = (
    "archive STRING, offset BIGINT, length BIGINT, record_id STRING, record_type STRING, "
    "target STRING, payload_digest STRING"
)
RECORD = (
    "page_id BIGINT, record_type STRING, target STRING, payload_bytes BIGINT, "
    "payload_digest STRING, refers_to BIGINT"
)


# Writing monolithic archives


def _urn(page_id: Column) -> Column:
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit(NO_ID)), F.lit(">")
    )


def _header_safe(url: Column) -> Column:
    """The url with blanks and control characters percent-encoded: a header is one line."""
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest and first: for a revisit, the page_id of the
    response it repeats; null for a response."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(html, 256).alias("payload_digest"),
        F.xxhash64(html).alias("key"),
    )
    large = rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
    repeated = common.cut(
        large.groupBy("payload_digest", "key")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("payload_digest", "first", "key")
    )
    single, may = common.split_by_bitmap(rows, "key", repeated.select("key"))
    copies = may.join(repeated.select("payload_digest", "first"), "payload_digest", "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    columns = [c for c in rows.columns if c != "key"]
    return single.select(*columns, F.lit(None).cast("long").alias("first")).unionAll(
        copies.select(*columns, first.alias("first"))
    )


def records(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """One column ``value``: each page as a whole WARC record, without the blank lines that end it."""
    page, digest = F.col("page_id"), F.col("payload_digest")
    target = F.coalesce(_header_safe(F.col("url")), F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit(NO_ID))))
    size = F.col("payload_bytes").cast("string")
    http = F.concat(
        F.lit(f"{HTTP_STATUS}{LINE_END}Content-Type: {HTML_TYPE}{LINE_END}Content-Length: "),
        size, F.lit(RECORD_END),
    )
    head = lambda kind: [
        F.lit(f"{VERSION}{LINE_END}WARC-Type: {kind}{LINE_END}WARC-Record-ID: "), _urn(page),
        F.lit(f"{LINE_END}WARC-Date: {captured}{LINE_END}WARC-Target-URI: "), target,
        F.lit(f"{LINE_END}WARC-Payload-Digest: sha256:"), digest,
        F.lit(f"{LINE_END}WARC-Payload-Length: "), size,
    ]
    response = F.concat(
        *head("response"),
        F.lit(f"{LINE_END}Content-Type: {RESPONSE_TYPE}{LINE_END}Content-Length: "),
        (F.octet_length(http) + F.octet_length("html")).cast("string"),
        F.lit(RECORD_END), http, F.col("html"),
    )
    revisit = F.concat(
        *head("revisit"),
        F.lit(f"{LINE_END}WARC-Profile: {REVISIT_PROFILE}{LINE_END}WARC-Refers-To: "),
        _urn(F.col("first")),
        F.lit(f"{LINE_END}Content-Length: 0{RECORD_END}"),
    )
    return decided(pages).select(F.when(F.col("first").isNull(), response).otherwise(revisit).alias("value"))


def write_monolithic(pages: DataFrame, folder: str, captured: str = CAPTURED) -> None:
    """Archives of the pages below ``folder``, each one gzip stream over all its records."""
    writer = records(pages, captured).write.option("compression", "gzip")
    writer.option("lineSep", RECORD_END).text(folder)


# Records of a stream


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/(?!/)", path):  # file:/folder
        path = path.replace(":/", ":///", 1)
    return pafs.FileSystem.from_uri(path)


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file in chunks, read once; of all members if there are several."""
    engine, open_member = zlib.decompressobj(31), False
    while data := source.read(CHUNK):
        while data:
            open_member = True
            if out := engine.decompress(data, CHUNK):
                yield out
            if engine.eof:
                data, engine, open_member = engine.unused_data, zlib.decompressobj(31), False
            else:
                data = engine.unconsumed_tail
    while open_member and (out := engine.decompress(engine.unconsumed_tail, CHUNK)):
        yield out
    if open_member and not engine.eof:
        raise ValueError("the gzip stream ends early")


class _Reader:
    """Reads a number of bytes, or up to a mark, from chunks."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.held = chunks, bytearray()

    def more(self) -> bool:
        chunk = next(self.chunks, None)
        if chunk is None:
            return False
        self.held += chunk
        return True

    def skip_blank_lines(self) -> bool:
        """Whether a record follows."""
        while True:
            while self.held and self.held[0] in b"\r\n":
                del self.held[0]
            if self.held:
                return True
            if not self.more():
                return False

    def head(self) -> bytes:
        end, mark = -1, RECORD_END.encode()
        while (end := self.held.find(mark)) < 0:
            if len(self.held) > LONGEST_HEAD or not self.more():
                raise ValueError("no end of a record's head")
        taken = bytes(self.held[: end + len(mark)])
        del self.held[: len(taken)]
        return taken

    def block(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self.more():
                raise ValueError("the archive ends within a record")
            taken = bytes(self.held[:size])
            del self.held[: len(taken)]
            size -= len(taken)
            yield taken

    def rest(self) -> Iterator[bytes]:
        while self.held or self.more():
            taken = bytes(self.held)
            self.held.clear()
            yield taken


def fields(head: bytes) -> dict[str, str]:
    """The fields of a record's head, names in lower case."""
    version, *lines = head.decode("utf-8", "replace").rstrip("\r\n").split(LINE_END)
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


# Normalising


def _fresh(store: pafs.FileSystem, temporary: str, final: str) -> None:
    """Moves a complete file to its name, in place of what an earlier attempt left there."""
    if store.get_file_info(final).type != pafs.FileType.NotFound:
        store.delete_file(final)
    store.move(temporary, final)


def normalise_file(path: str, target: str) -> None:
    """Rewrites one archive, a member per record, and its sidecar ``<target>.cdxj``; both appear when
    they are complete, the sidecar last."""
    store, place = _store(path)
    out_store, out = _store(target)
    attempt = f"{uuid.uuid4().hex}.part"
    offset = 0
    with (
        store.open_input_stream(place, compression=None) as source,
        out_store.open_output_stream(f"{out}.{attempt}", compression=None) as archive,
        out_store.open_output_stream(f"{out}.cdxj.{attempt}", compression=None) as sidecar,
    ):
        reader = _Reader(inflated(source))
        while reader.skip_blank_lines():
            head = reader.head()
            named = fields(head)
            member, start = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31), offset
            block = reader.block(int(named["content-length"]))
            for part in itertools.chain([head], block, [RECORD_END.encode()]):
                offset += archive.write(member.compress(part))
            offset += archive.write(member.flush())
            line = {
                "archive": target, "offset": start, "length": offset - start,
                "record_id": named.get("warc-record-id"), "record_type": named.get("warc-type"),
                "target": named.get("warc-target-uri"),
                "payload_digest": named.get("warc-payload-digest"),
            }
            sidecar.write(json.dumps(line).encode() + b"\n")
    _fresh(out_store, f"{out}.{attempt}", out)
    _fresh(out_store, f"{out}.cdxj.{attempt}", f"{out}.cdxj")


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            targets = [f"{folder}/{p.rpartition('/')[2].split('.')[0]}.warc.gz" for p in paths]
            for path, target in zip(paths, targets):
                normalise_file(path, target)
            yield pa.RecordBatch.from_arrays([pa.array(targets, pa.string())], names=["archive"])

    return run


def normalise(spark: SparkSession, archives: str, folder: str) -> DataFrame:
    """Rewrites every ``*.gz`` below ``archives`` into ``folder`` and returns the offset index.

    The base names of the archives must differ. A task takes one file after the other.
    """
    store, place = _store(folder)
    store.create_dir(place, recursive=True)  # an empty index needs a folder too
    # Only the names are read here: the content of the files stays where it is.
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives)
    names.select("path").mapInArrow(_normalise(folder), "archive STRING").write.format("noop").mode(
        "overwrite"
    ).save()
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecars of a folder: archive, offset and length of each record's member, and its head."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.cdxj").json(folder)


# Reading back


class _Member:
    """One member of an archive as a source; what is read beyond it serves the next member."""

    def __init__(self, file) -> None:
        self.file, self.start, self.window = file, 0, b""
        self.at = self.end = 0

    def seek(self, offset: int, length: int) -> _Member:
        self.at, self.end = offset, offset + length
        return self

    def read(self, size: int) -> bytes:
        size = min(size, self.end - self.at)
        place = self.at - self.start
        if not 0 <= place <= len(self.window) - size:
            self.start, self.window, place = self.at, self.file.read_at(CHUNK, self.at), 0
        taken = self.window[place : place + size]
        self.at += len(taken)
        return taken


def _page_id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def parse_record(source, keep_payload: bool = False) -> dict:
    """The record of one member; its payload is hashed as it comes, and kept only on demand."""
    reader = _Reader(inflated(source))
    named = fields(reader.head())
    digest, size, kept = hashlib.sha256(), 0, []
    said = named.get("warc-payload-digest", "")
    block = _Reader(reader.block(int(named["content-length"])))
    if named.get("content-type", "").startswith("application/http"):
        block.head()
    if named["warc-type"] != "revisit":
        for part in block.rest():
            digest.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        if said.startswith("sha256:") and said != f"sha256:{digest.hexdigest()}":
            raise ValueError(f"payload of {named.get('warc-record-id')} does not match its digest")
        said = digest.hexdigest()
    else:
        size = int(named["warc-payload-length"]) if "warc-payload-length" in named else None
    return {
        "page_id": _page_id(named.get("warc-record-id")),
        "record_type": named["warc-type"],
        "target": named.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": said.removeprefix("sha256:"),
        "refers_to": _page_id(named.get("warc-refers-to")),
    } | ({"payload": b"".join(kept) if named["warc-type"] != "revisit" else None} if keep_payload else {})


def _read(keep_payload: bool):
    types = {
        "page_id": pa.int64(), "record_type": pa.string(), "target": pa.string(),
        "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if keep_payload else {})
    schema = pa.schema(list(types.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, member = None, None, None
        for batch in batches:
            rows, held = [], 0
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != path:
                    if file:
                        file.close()
                    store, place = _store(archive)
                    path, file = archive, store.open_input_file(place)
                    member = _Member(file)
                rows.append(parse_record(member.seek(offset, length), keep_payload))
                held += rows[-1]["payload_bytes"] or 0 if keep_payload else 0
                if held >= 8 * CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)
        if file:
            file.close()

    return run


def read_records(index: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Each record of the index, read at its offset: page_id, record_type, target, payload_bytes,
    payload_digest, refers_to, and with ``keep_payload`` the payload (null for a revisit).

    Digests of responses are computed from what was read. Tasks read the ranges of their part of the
    index; rows of one sidecar come in the order of the archive, so reading is sequential.
    """
    schema = RECORD + (", payload BINARY" if keep_payload else "")
    return index.select("archive", "offset", "length").mapInArrow(_read(keep_payload), schema)


def page_records(pages: DataFrame) -> DataFrame:
    """Every page through archives and back: page_id, payload_bytes, payload_digest, record_type,
    refers_to."""
    spark = pages.sparkSession
    root = common.scratch(spark)
    write_monolithic(pages, f"{root}/monolithic")
    index = normalise(spark, f"{root}/monolithic", f"{root}/members")
    return read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def oracle(pages: str = "pages") -> str:
    return f"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html FROM {pages}
), digests AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM rows
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM digests WHERE payload_bytes >= {REVISIT_BYTES}
  GROUP BY payload_digest
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM d.page_id THEN 'response' ELSE 'revisit' END
    AS record_type,
  CASE WHEN f.first IS DISTINCT FROM d.page_id THEN f.first END AS refers_to
FROM digests d LEFT JOIN firsts f ON d.payload_digest = f.payload_digest
"""
