"""Media columns: payloads kept in archives and read back through a data source.

``write_archives`` packs one media member per row into zip archives of bounded
size in a shared folder. The data source ``media_archive`` plans partitions as
byte ranges of those archives: a range owns the members whose header begins in
it, found in the archive's own directory. Members stream out as Arrow batches
of bounded size, and each is read by its offset alone, so a member that fails
is read again by itself.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ._common import file_system, fresh_dir, small_batches, task_id

BLOCK = 576
FILL = b"\xff"
RATE = 8000
ARCHIVE_BYTES = 32 << 20
SPLIT_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
_WAV = struct.Struct("<4sI4s4sIHHIIHH4sI")
_LOCAL = struct.Struct("<4s5H3I2H")


def pack(text: str | None) -> bytes:
    """A text's UTF-8 (null: none), filled with bytes 255 up to a positive multiple of 576."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + FILL * (max(BLOCK, -(-len(raw) // BLOCK) * BLOCK) - len(raw))


def to_media(samples: bytes) -> bytes:
    """A mono wave file whose 8-bit samples are exactly these bytes."""
    n = len(samples)
    return _WAV.pack(b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n) + samples


def from_media(media: bytes) -> bytes:
    """The samples of such a file; ValueError if it is none or cut short."""
    if len(media) < _WAV.size:
        raise ValueError("wave file cut short")
    riff, _, wave, *_, bits, data, n = _WAV.unpack_from(media)
    if (riff, wave, data, bits) != (b"RIFF", b"WAVE", b"data", 8) or len(media) != _WAV.size + n:
        raise ValueError("not an 8-bit wave file, or cut short")
    return media[_WAV.size:]


def feature(samples: bytes) -> str:
    """Mean, root mean square, mean crossings and a 64-bit envelope hash of the samples.

    The hash has a bit for each of 64 equal stretches, set where the stretch is
    louder than the mean; equal samples give equal features.
    """
    x = np.frombuffer(samples, np.uint8).astype(np.float32)
    if not x.size:
        return ""
    mean = float(x.mean(dtype=np.float64))
    above = x > mean
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    rms = float(np.sqrt(np.square(x - np.float32(128)).mean(dtype=np.float64)))
    parts = np.resize(x, (64, max(1, x.size // 64))).mean(axis=1, dtype=np.float64) > mean
    envelope = int(np.packbits(parts).view(">u8")[0])
    return f"mean={mean:.4f};rms={rms:.4f};crossings={crossings};envelope={envelope:016x}"


def write_archives(df: DataFrame, path: str, id_col: str, text_col: str, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write a member for each row into archives below ``path``; returns the number of members.

    A task names its archives by its partition and moves each into place when
    complete, so a repeated attempt replaces what an earlier one left. Members
    are named by their place and the row's id; a null id is left out.
    """
    small_batches(df.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(path)
        part, attempt = task_id()
        members = files = 0
        buffer, archive = None, None

        def close() -> None:
            nonlocal buffer, archive, files
            archive.close()
            name = f"part-{part:06d}-{files:05d}.zip"
            fs.create_dir(at, recursive=True)
            with fs.open_output_stream(f"{at}/.{name}.{attempt}") as out:
                out.write(buffer.getbuffer())
            fs.move(f"{at}/.{name}.{attempt}", f"{at}/{name}")
            buffer, archive, files = None, None, files + 1

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                if archive is None:
                    buffer = io.BytesIO()
                    archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
                key = key.as_py()
                info = zipfile.ZipInfo(f"{members:09d}_{'' if key is None else key}.wav")
                info.compress_type = zipfile.ZIP_DEFLATED
                archive.writestr(info, to_media(pack(text.as_py())), compresslevel=1)
                members += 1
                if buffer.tell() >= archive_bytes:
                    close()
        if archive is not None:
            close()
        yield pa.RecordBatch.from_pydict({"members": pa.array([members], pa.int64())})

    done = df.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(of, "members long")
    return done.agg(F.sum("members")).first()[0] or 0


@dataclass
class _Range(InputPartition):
    archive: str
    start: int
    end: int


def read_member(fs, archive: str, offset: int, size: int, kind: int, crc: int, retries: int, handle=None) -> bytes:
    """The member whose local header begins at ``offset``, read again up to ``retries`` times if that fails.

    Every retry opens the archive anew and reads this member only. OSError if
    all attempts fail.
    """
    for attempt in range(retries + 1):
        own = handle if attempt == 0 else None
        try:
            if own is None:
                own = fs.open_input_file(archive)
            own.seek(offset)
            mark, *_, name, extra = _LOCAL.unpack(own.read(_LOCAL.size))
            if mark != b"PK\x03\x04":
                raise ValueError("no member begins here")
            own.seek(offset + _LOCAL.size + name + extra)
            raw = own.read(size)
            data = zlib.decompress(raw, -15) if kind == zipfile.ZIP_DEFLATED else raw
            if zlib.crc32(data) != crc:
                raise ValueError("checksum differs")
            return data
        except (OSError, ValueError, zlib.error, struct.error) as e:
            if attempt == retries:
                raise OSError(f"{archive} at {offset}: {e}") from e
        finally:
            if own is not None and own is not handle:
                own.close()
    raise AssertionError


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.retries = int(options.get("retries", 2))
        self.skip = str(options.get("onerror", "fail")).lower() == "null"

    def partitions(self) -> list[InputPartition]:
        """Ranges of at most ``splitbytes`` bytes, from the archives' sizes alone."""
        from pyarrow.fs import FileSelector

        fs, at = file_system(self.path)
        files = fs.get_file_info(FileSelector(at, allow_not_found=True))
        ranges: list[InputPartition] = [
            _Range(f.path, start, min(start + self.split, f.size))
            for f in sorted(files, key=lambda f: f.path)
            if f.base_name.endswith(".zip") and f.base_name[0] != "."
            for start in range(0, f.size, self.split)
        ]
        return ranges or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        fs, _ = file_system(self.path)
        columns: list[list] = [[], [], [], [], [], [], []]
        held = 0

        def batch() -> pa.RecordBatch:
            kinds = [f.type for f in ARROW]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=ARROW)
            for c in columns:
                c.clear()
            return out

        with fs.open_input_file(partition.archive) as handle:
            with zipfile.ZipFile(handle) as archive:
                inside = [
                    (m.header_offset, m.filename, m.compress_size, m.compress_type, m.CRC)
                    for m in archive.infolist()
                    if partition.start <= m.header_offset < partition.end
                ]
            for offset, name, size, kind, crc in sorted(inside):
                try:
                    media = read_member(fs, partition.archive, offset, size, kind, crc, self.retries, handle)
                    samples = from_media(media)
                    row = (media, len(samples.rstrip(FILL)), feature(samples), None)
                except (OSError, ValueError) as e:
                    if not self.skip:
                        raise
                    row = (None, None, None, str(e))
                for c, v in zip(columns, (partition.archive, name, offset, *row)):
                    c.append(v)
                held += len(row[0] or b"")
                if held >= BATCH_BYTES:
                    yield batch()
                    held = 0
        if columns[0]:
            yield batch()


SCHEMA = "archive string, member string, offset long, media binary, n_bytes long, feature string, error string"
ARROW = pa.schema([
    ("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()),
    ("n_bytes", pa.int64()), ("feature", pa.string()), ("error", pa.string()),
])


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(folder)``: a row for each member of the folder's archives.

    Options: ``splitBytes`` (bytes of an archive per partition), ``retries``
    (further attempts per member), ``onError`` (``fail``, or ``null`` to give
    the member a row with null media and its error).
    """

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**options).load(path)


def media_round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every row's text as media, read it back, and describe what was read.

    (id_col, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature). A null text counts as empty; an empty one is one
    block of fill. Rows that repeat an id each have a member and a row; null
    ids stay null; other columns are ignored; an empty table gives an empty one.
    """
    spark = df.sparkSession
    at = fresh_dir(spark, "media")
    write_archives(df, at, id_col, text_col)
    kind = df.schema[id_col].dataType
    key = F.nullif(F.regexp_extract("member", r"(?s)^\d+_(.*)\.wav$", 1), F.lit(""))
    payload = F.expr(f"substring(media, {_WAV.size + 1})")
    return read_archives(spark, at).select(
        key.cast(kind).alias(id_col),
        "n_bytes",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.expr(f"substring(media, -32, 32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
