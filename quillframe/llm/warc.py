"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

A monolithic file is one gzip stream over all its records, which cannot be
entered in the middle. ``normalise`` inflates such a stream once, front to
back, rewrites every record as a gzip member of its own and writes a sidecar
index of the members' offsets; ``read_indexed`` then reads records by offset.
Files have a bounded size, so one task for each is bounded too.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import file_system, fresh_dir, partitions, small_batches, task_id, written

FILE_BYTES = 64 << 20
_STEP = 1 << 20
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31


def record(key: str | None, url: str | None, payload: bytes, digest: str, first: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit of ``first`` without it.

    The HTTP head of either states the whole payload's length. The row's id and
    that of the response revisited are kept in extension fields.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if first is None else b"")
    named = lambda k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, k or '')}>"
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {named(key)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {quote(url or 'about:blank', safe=_URI)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if key is not None:
        fields.append(f"X-Row-ID: {quote(key, safe=_ID)}")
    if first is not None:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {named(first)}", f"X-Refers-To-Row-ID: {quote(first, safe=_ID)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI = "!#$%&'()*+,/:;=?@[]~-._"
_ID = _URI.replace("%", "")


def fields_of(head: bytes) -> dict[str, str]:
    """The fields of a WARC or HTTP head, by lower-case name; the first line under the empty name."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    out = {"": lines[0]}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _plain(field: str | None) -> str | None:
    return None if field is None else unquote(field)


def inflate(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or many members, in pieces of bounded size."""
    engine, raw, begun = zlib.decompressobj(_GZIP), read(_STEP), False
    while raw:
        begun = True
        if piece := engine.decompress(raw, _STEP):
            yield piece
        if engine.eof:
            raw, engine, begun = engine.unused_data or read(_STEP), zlib.decompressobj(_GZIP), False
        else:
            raw = engine.unconsumed_tail or read(_STEP)
    while begun and not engine.eof and (piece := engine.decompress(b"", _STEP)):
        yield piece
    if begun and not engine.eof:
        raise ValueError("the gzip stream is cut short")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The whole records of a WARC byte stream, head, block and closing line ends; ValueError if one is cut short."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        start = 0
        while (end := held.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(held) - 3)
            if not more():
                if held.strip():
                    raise ValueError("a record's head is cut short")
                return
        length = fields_of(bytes(held[:end])).get("content-length", "")
        if not length.isdecimal():
            raise ValueError("a record does not state its length")
        whole = end + 4 + int(length) + 4
        while len(held) < whole:
            if not more():
                raise ValueError("a record's block is cut short")
        yield bytes(held[:whole])
        del held[:whole]


class _Moved:
    """An output stream that takes its name only when it is complete."""

    def __init__(self, fs, path: str, attempt: int):
        folder, _, name = path.rpartition("/")
        fs.create_dir(folder, recursive=True)
        self.fs, self.path, self.temporary, self.at = fs, path, f"{folder}/.{name}.{attempt}", 0
        self.out = fs.open_output_stream(self.temporary, buffer_size=_STEP)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.path)


def write_monolithic(df: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(file, records) of the monolithic files written below ``path``, one gzip stream each.

    ``df`` has key, url, payload (binary), digest (its SHA-1 in hex) and first, as
    ``record`` takes them. A file is closed when it holds ``file_bytes`` plain bytes.
    """
    small_batches(df.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(path)
        part, attempt = task_id()
        files: list[str] = []
        counts: list[int] = []
        out, engine, plain = None, None, 0

        def close() -> None:
            nonlocal out
            out.write(engine.flush())
            out.close()
            out = None

        for batch in batches:
            for key, url, payload, digest, first in zip(*batch.columns):
                if out is None:
                    files.append(f"part-{part:06d}-{len(files):05d}.warc.gz")
                    counts.append(0)
                    out, engine, plain = _Moved(fs, f"{at}/{files[-1]}", attempt), zlib.compressobj(1, zlib.DEFLATED, _GZIP), 0
                whole = record(key.as_py(), url.as_py(), payload.as_py(), base64.b32encode(bytes.fromhex(digest.as_py())).decode(), first.as_py())
                out.write(engine.compress(whole))
                counts[-1] += 1
                plain += len(whole)
                if plain >= file_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"file": pa.array(files, pa.string()), "records": pa.array(counts, pa.int64())})

    return written(df.select("key", "url", "payload", "digest", "first").mapInArrow(of, "file string, records long"), "warc-files")


def _one_each(files: DataFrame) -> DataFrame:
    """The files of a list, dealt evenly, one to a task or a few where they are many."""
    return files.select("file").coalesce(1).repartition(max(1, min(files.count(), 64 * partitions(files.sparkSession))))


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """(file, records) of the normalised files below ``target``, each with its sidecar index ``<file>.idx``.

    ``files`` lists file names below ``source``. Every line of an index is a
    JSON object with a member's offset, length, record id and type.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, at = file_system(source)
        dst, to = file_system(target)
        _, attempt = task_id()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                members, index, n = _Moved(dst, f"{to}/{name}", attempt), _Moved(dst, f"{to}/{name}.idx", attempt), 0
                with src.open_input_stream(f"{at}/{name}", compression=None) as raw:
                    for whole in records(inflate(raw.read)):
                        engine = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
                        member = engine.compress(whole) + engine.flush()
                        head = fields_of(whole[:whole.find(b"\r\n\r\n")])
                        line = {"offset": members.at, "length": len(member), "id": head.get("warc-record-id"), "type": head.get("warc-type")}
                        index.write(json.dumps(line).encode() + b"\n")
                        members.write(member)
                        n += 1
                members.close()
                index.close()
                yield pa.RecordBatch.from_pydict({"file": pa.array([name]), "records": pa.array([n], pa.int64())})

    return written(_one_each(files).mapInArrow(of, "file string, records long"), "warc-files")


def read_indexed(files: DataFrame, path: str) -> DataFrame:
    """The records of normalised files, each read by its offset in the sidecar index.

    (key, payload_bytes, payload_digest, record_type, refers_to, file, offset).
    A response's digest is computed from the payload read and must be the one
    its head states; a revisit's digest and length are those of its head.
    """

    def row(member: bytes) -> tuple:
        whole = zlib.decompress(member, _GZIP)
        end = whole.find(b"\r\n\r\n")
        head = fields_of(whole[:end])
        body = end + 4 + whole[end + 4:].find(b"\r\n\r\n") + 4
        http = fields_of(whole[end + 4:body - 4])
        length, digest, kind = int(http["content-length"]), head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
        if kind == "response":
            payload = whole[body:end + 4 + int(head["content-length"])]
            if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"{head.get('warc-record-id')}: the payload is not the one its head states")
        return _plain(head.get("x-row-id")), length, digest, kind, _plain(head.get("x-refers-to-row-id"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{at}/{name}.idx", compression=None) as lines, fs.open_input_file(f"{at}/{name}") as members:
                    for line in _lines(lines.read):
                        entry = json.loads(line)
                        members.seek(entry["offset"])
                        rows.append((*row(members.read(entry["length"])), name, entry["offset"]))
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return _one_each(files).mapInArrow(
        of, "key string, payload_bytes long, payload_digest string, record_type string, refers_to string, file string, offset long"
    )


def _lines(read: Callable[[int], bytes]) -> Iterator[bytes]:
    held = b""
    while piece := read(_STEP):
        *whole, held = (held + piece).split(b"\n")
        yield from whole
    if held:
        yield held


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def warc_round_trip(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write every row as a WARC record, normalise the archives, and read them back by index.

    (id_col, payload_bytes, payload_digest, record_type, refers_to, file,
    offset). Of rows with equal payloads of at least ``min_bytes`` bytes the
    one with the smallest id is the response and the others revisit it; rows
    that repeat that smallest id are responses each. A null payload counts as
    empty. A null id is larger than any id; where all ids of a payload are null
    all are responses. Other columns are ignored, and an empty table gives an
    empty one.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    pages = df.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    repeated = written(
        pages.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("least").isNotNull()).select("sha", "least"),
        "repeated",
    )
    marked = pages.join(repeated, "sha", "left").select(
        F.col("id").cast("string").alias("key"), "url", "payload", F.col("sha").alias("digest"),
        F.when(F.col("least").isNotNull() & ~F.col("id").eqNullSafe(F.col("least")), F.col("least").cast("string")).alias("first"),
    )
    source, target = fresh_dir(spark, "warc"), fresh_dir(spark, "warc-normal")
    files = write_monolithic(marked, source, file_bytes)
    found = read_indexed(normalise(files, source, target), target)
    return found.select(
        F.col("key").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "file", "offset",
    )
