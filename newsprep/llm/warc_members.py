"""WARC archives: writing, and turning one long gzip stream into a member per record."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import written
from newsprep.session import new_path

#: Payload bytes after which a new archive is begun, bytes read at a time, zlib's level.
ARCHIVE_BYTES, READ, LEVEL = 256 << 20, 1 << 20, 6
#: A fixed date, since pages carry none and archives should not depend on the hour.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _files(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, revisit: bool, refers_to) -> bytes:
    """One WARC record: a response, or a revisit without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page", refers_to),
        ]
    if page_id is not None:
        fields.append(("X-Page", page_id))
    fields += [
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    """The named fields of a header, names in lower case."""
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file, of one member or several, a piece at a time."""
    member = zlib.decompressobj(31)
    while piece := source.read(READ):
        while piece:
            if member.eof:
                member = zlib.decompressobj(31)
            yield member.decompress(piece, READ)
            while member.unconsumed_tail:
                yield member.decompress(member.unconsumed_tail, READ)
            piece = member.unused_data
    if not member.eof:
        raise ValueError("the gzip stream is cut short")


def records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record's fields and its bytes; one record is held at a time."""
    buffer = bytearray()
    pieces = iter(pieces)

    def more() -> bool:
        for piece in pieces:
            if piece:
                buffer.extend(piece)
                return True
        return False

    while buffer or more():
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(buffer) - 3)
            if not more():
                raise ValueError("the archive ends within a header")
        fields = fields_of(bytes(buffer[:end]))
        total = end + 4 + int(fields["content-length"]) + 4
        while len(buffer) < total:
            if not more():
                raise ValueError("the archive ends within a record")
        yield fields, bytes(buffer[:total])
        del buffer[:total]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, payload, revisit, refers_to) as whole-file gzip streams.

    Returns path, records. A task writes files of its own with names never used before;
    only those of attempts that succeeded are named in the result, so what a lost
    attempt has left is never read.
    """
    out = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _files(folder)
        files.create_dir(top)
        name = stream = press = None
        done, n, held = [], 0, 0

        def close():
            stream.write(press.flush())
            stream.close()
            done.append((f"{folder}/{name}", n))

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if stream is None:
                    name, n, held = f"{uuid.uuid4().hex}.whole.warc.gz", 0, 0
                    stream = files.open_output_stream(f"{top}/{name}", compression=None)
                    press = zlib.compressobj(LEVEL, wbits=31)
                values = [v.as_py() for v in row]
                values[2] = values[2] or b""
                stream.write(press.compress(record(*values)))
                n, held = n + 1, held + len(values[2])
                if held >= ARCHIVE_BYTES:
                    close()
                    stream = None
        if stream is not None:
            close()
        columns = [pa.array([d[k] for d in done], out.field(k).type) for k in range(2)]
        yield pa.RecordBatch.from_arrays(columns, schema=out)

    selected = pages.select("page_id", "url", "payload", "revisit", "refers_to")
    return selected.mapInArrow(run, "path string, records bigint")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of the column path with one gzip member per record.

    Returns path, index, records. An archive is inflated once, as a stream: of whatever
    length it is, a task holds one record. The index beside it has a line for each record:
    offset and length of its member, its type, id and page. Any gzip archive is read,
    those that have members already too. Names are new for each attempt.
    """
    out = pa.schema([("path", pa.string()), ("index", pa.string()), ("records", pa.int64())])

    def one(path: str) -> tuple[str, str, int]:
        files, at = _files(path)
        to, top = _files(folder)
        to.create_dir(top)
        name, offset, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
        with (
            files.open_input_stream(at, compression=None) as source,
            to.open_output_stream(f"{top}/{name}", compression=None) as target,
            to.open_output_stream(f"{top}/{name}.idx", compression=None) as index,
        ):
            for fields, whole in records(inflated(source)):
                press = zlib.compressobj(LEVEL, wbits=31)
                member = press.compress(whole) + press.flush()
                target.write(member)
                line = {
                    "offset": offset,
                    "length": len(member),
                    "type": fields.get("warc-type"),
                    "id": fields.get("warc-record-id"),
                    "page": fields.get("x-page"),
                }
                index.write(json.dumps(line).encode() + b"\n")
                offset, n = offset + len(member), n + 1
        return f"{folder}/{name}", f"{folder}/{name}.idx", n

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(path.as_py()) for path in batch.column(0)]
            columns = [pa.array([r[k] for r in rows], out.field(k).type) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return archives.select("path").mapInArrow(run, "path string, index string, records bigint")


READ_BACK = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint"
)


def read_members(archives: DataFrame) -> DataFrame:
    """The records of archives (path, index), each read at its offset and checked.

    A response's payload must have the digest and the length that its header states.
    """
    out = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def parse(member: bytes) -> tuple:
        whole = zlib.decompress(member, 31)
        head, _, rest = whole.partition(b"\r\n\r\n")
        fields = fields_of(head)
        http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
        size = int(fields_of(http)["content-length"])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response":
            held = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if (len(payload), held) != (size, digest):
                raise ValueError(f"record {fields['warc-record-id']} is damaged")
        page, first = fields.get("x-page"), fields.get("x-refers-to-page")
        return (
            None if page is None else int(page), size, digest, fields["warc-type"],
            None if first is None else int(first),
        )

    def members(path: str, index: str) -> Iterator[bytes]:
        files, at = _files(path)
        _, beside = _files(index)
        with files.open_input_file(at) as archive, files.open_input_stream(
            beside, compression=None
        ) as lines:
            rest = b""
            while True:
                piece = lines.read(READ)
                *whole, rest = (rest + piece).split(b"\n")
                for line in map(json.loads, whole):
                    archive.seek(line["offset"])
                    yield archive.read(line["length"])
                if not piece:
                    return

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            columns = [pa.array([r[k] for r in rows], out.field(k).type) for k in range(5)]
            return pa.RecordBatch.from_arrays(columns, schema=out)

        for batch in batches:
            for path, index in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for member in members(path.as_py(), index.as_py()):
                    rows.append(parse(member))
                    if len(rows) == 4096:
                        yield batch_of(rows)
                        rows = []
                yield batch_of(rows)

    return archives.select("path", "index").mapInArrow(run, READ_BACK)


def with_revisits(
    pages: DataFrame, *, least: int, id_col: str, url_col: str, html_col: str
) -> DataFrame:
    """page_id, url, payload, revisit, refers_to for each page.

    Payloads are compared by digest. Only those that occur twice or more are joined, and
    their table is written first: Spark sees its size, broadcasts it while it is small,
    and otherwise splits a payload that very many pages share as any skewed join key.
    """
    payload = F.encode(F.coalesce(html_col, F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    repeated = (
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    repeated = written(repeated, "repeated")
    return rows.join(repeated, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        (F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"),
        F.col("first").alias("refers_to"),
    )


def warc_round_trip(
    pages: DataFrame,
    *,
    least: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write pages as WARC archives, normalise these, and return what their members say.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Of
    pages with equal payloads of at least least bytes, the one with the least page_id is
    a response, the others are revisits of it without a payload. The archives are first
    written as one gzip stream each, as some crawlers do; normalise_archives() gives each
    record a member of its own and an index of offsets, and read_members() reads by it.

    Null html is an empty payload, a null url an empty target. A null page_id is larger
    than any other; a group of null ids alone are all responses, and so are rows that
    repeat the least page_id with its payload. An empty table gives no rows, other columns
    are ignored.
    """
    spark = pages.sparkSession
    typed = with_revisits(pages, least=least, id_col=id_col, url_col=url_col, html_col=html_col)
    folder = new_path(spark, "warc")
    whole = written(write_archives(typed, f"{folder}/whole"), "archives")
    n = max(1, whole.count())
    single = written(
        normalise_archives(whole.repartition(n), f"{folder}/members"), "normalised"
    )
    return read_members(single.repartition(n))
