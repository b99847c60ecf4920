"""Image sizes from file headers: a data source that reads the first kilobytes of a file and its last bytes.

Partitions are planned by the bytes that will be read; filters on split are pushed down,
so that other folders aren't even listed. PNG chunks and JPEG segments are walked up to
the size and the EXIF orientation, wherever in the file they stand; a file without its
end mark is told as unreadable, as a decoder would find.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from roadlens.sources.folders import PART_BYTES, Files, FolderReader

FORMAT = "image_headers"
#: Bytes read first, and bytes at the end in which the end mark must stand.
HEAD, TAIL = 4096, 64
SUFFIXES = (".jpg", ".jpeg", ".png")
SCHEMA = "path string, split string, file_name string, stem string, ext string, length long, format string, width int, height int, orientation int, readable boolean, bytes_read long"
_PNG, _IEND = b"\x89PNG\r\n\x1a\n", b"\x00\x00\x00\x00IEND\xaeB`\x82"
#: Markers of JPEG frames; those without a length.
_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
_BARE = frozenset({0x01, *range(0xD0, 0xD9)})
_ORIENTATION = 0x0112


class Counted:
    """Bytes of a file by place and number, the head read once; ``read`` counts those that were fetched."""

    def __init__(self, fetch: Callable[[int, int], bytes], length: int):
        self.fetch, self.length, self.read = fetch, length, 0
        self.head = self._get(0, min(HEAD, length))

    def _get(self, at: int, n: int) -> bytes:
        data = self.fetch(at, n)
        self.read += len(data)
        return data

    def at(self, place: int, n: int) -> bytes:
        """Up to n bytes; fewer at the end of the file."""
        n = min(n, self.length - place)
        if n <= 0:
            return b""
        return self.head[place : place + n] if place + n <= len(self.head) else self._get(place, n)


def exif_orientation(tiff: bytes) -> int:
    """The orientation that EXIF data tells, from 1 to 8; 1 if it tells none."""
    order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    if order is None or len(tiff) < 8:
        return 1
    (begin,) = struct.unpack_from(f"{order}I", tiff, 4)
    if begin + 2 > len(tiff):
        return 1
    (entries,) = struct.unpack_from(f"{order}H", tiff, begin)
    for k in range(entries):
        at = begin + 2 + 12 * k
        if at + 12 > len(tiff):
            break
        tag, kind, n = struct.unpack_from(f"{order}HHI", tiff, at)
        if tag == _ORIENTATION and kind == 3 and n >= 1:
            (value,) = struct.unpack_from(f"{order}H", tiff, at + 8)
            return value if 1 <= value <= 8 else 1
    return 1


def _png(f: Counted) -> tuple[int, int, int] | None:
    first = f.at(8, 25)
    if len(first) < 25 or first[:8] != b"\x00\x00\x00\rIHDR" or zlib.crc32(first[4:21]) != int.from_bytes(first[21:], "big"):
        return None
    width, height = struct.unpack_from(">II", first, 8)
    at, turned = 33, 1
    while len(mark := f.at(at, 8)) == 8 and mark[4:] not in (b"IDAT", b"IEND"):
        n = int.from_bytes(mark[:4], "big")
        if mark[4:] == b"eXIf":
            turned = exif_orientation(f.at(at + 8, n))
        at += 12 + n
    return (width, height, turned) if f.at(f.length - 12, 12) == _IEND else None


def _jpeg(f: Counted) -> tuple[int, int, int] | None:
    at, turned = 2, 1
    while len(mark := f.at(at, 4)) == 4 and mark[0] == 0xFF:
        if mark[1] == 0xFF:  # fill bytes
            at += 1
        elif mark[1] in _BARE:
            at += 2
        elif mark[1] in _FRAMES:
            frame = f.at(at + 4, 5)
            if len(frame) < 5 or b"\xff\xd9" not in f.at(max(at, f.length - TAIL), TAIL):
                return None
            height, width = struct.unpack(">HH", frame[1:])
            return width, height, turned
        elif mark[1] in (0xD9, 0xDA):
            return None
        else:
            n = int.from_bytes(mark[2:], "big")
            if mark[1] == 0xE1 and f.at(at + 4, 6) == b"Exif\0\0":
                turned = exif_orientation(f.at(at + 10, n - 8))
            at += 2 + max(2, n)
    return None


def probe(fetch: Callable[[int, int], bytes], length: int) -> tuple[str | None, int, int, int, bool, int]:
    """(format, width, height, orientation, readable, bytes fetched) of a file; sizes are -1 where it can't be read.

    Sizes are those of the stored pixels. ``shown_size`` turns them as the orientation says.
    """
    f = Counted(fetch, length)
    kind, found = None, None
    if f.head.startswith(_PNG):
        kind, found = "png", _png(f)
    elif f.head.startswith(b"\xff\xd8"):
        kind, found = "jpeg", _jpeg(f)
    if found is None or not found[0] or not found[1]:
        return kind, -1, -1, 1, False, f.read
    return kind, *found, True, f.read


def shown_size(images: DataFrame) -> DataFrame:
    """Adds shown_width and shown_height: width and height change places where the orientation lays the picture on its side."""
    lies = F.col("orientation") >= 5
    size = lambda a, b: F.when(lies, F.col(b)).otherwise(F.col(a))
    return images.withColumn("shown_width", size("width", "height")).withColumn("shown_height", size("height", "width"))


def probe_contents(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, format, width, height, orientation, readable, bytes_read) of files that stand in a column; null content isn't readable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column(1):
                data = memoryview(cell.as_buffer()) if cell.is_valid else memoryview(b"")
                rows.append(probe(lambda at, n, d=data: bytes(d[at : at + n]), len(data)))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
            yield pa.record_batch([batch.column(0), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))], names=[key, "format", "width", "height", "orientation", "readable", "bytes_read"])

    kind = files.schema[key].dataType.simpleString()
    return files.select(key, F.col(content).cast("binary").alias("content")).mapInArrow(run, f"{key} {kind}, format string, width int, height int, orientation int, readable boolean, bytes_read long")


class HeaderReader(FolderReader):
    suffixes = SUFFIXES

    def cost(self, length: int) -> int:
        return min(length, HEAD + TAIL)

    def read(self, partition: Files) -> Iterator[tuple]:
        for split, path, length, f in self.opened_files(partition):
            kind, width, height, turned, readable, read = probe(lambda at, n, f=f: f.read_at(n, at), length)
            name = path.rpartition("/")[2]
            stem, dot, suffix = name.rpartition(".")
            yield path, split, name, stem if stem else name, dot + suffix if stem else "", length, kind, width, height, turned, readable, read


class ImageHeaders(DataSource):
    """Images of path/images/<split>/ with what their headers tell."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(self.options["path"].rstrip("/") + "/images", int(self.options.get("partbytes", PART_BYTES)))


def read_headers(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """The columns of ``SCHEMA`` of every image of a layout dataset, in any letter case of its suffix. Splits without images have no rows."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ImageHeaders)
    return spark.read.format(FORMAT).option("partBytes", part_bytes).load(path)
