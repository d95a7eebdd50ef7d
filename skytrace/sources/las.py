"""``las``: point clouds in the ASPRS LAS format (1.0 to 1.4, record formats 0 to 10).

Records have a fixed width, so a file splits into ranges that tasks read on their own. Ranges are made
from the sizes in the folder's listing; a file's header is read by the tasks that read the file.
Options of the reader: ``path`` (file or folder), ``records`` per partition at most.
Options of the writer: ``path`` (folder), ``scale`` of the stored coordinates, ``offset_x/y/z``.

The scan angle is in degrees in all formats. ``class_flags`` are bits: 1 synthetic, 2 key point,
4 withheld, 8 overlap. Waveform packets are not read.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from skytrace.sources.files import (
    StagedFolder,
    file_size,
    list_sizes,
    packed,
    qualified,
    read_range,
    write_file,
)

RECORDS = 1 << 20
#: Bytes of the shortest record, and what opening a file counts for when small files share a task.
SHORTEST = 20
OPENING = 1 << 16
FILE_POINTS = 1 << 22
BATCH = 1 << 16

# Layout of the point record formats.
_XYZ = [("X", "<i4"), ("Y", "<i4"), ("Z", "<i4"), ("intensity", "<u2")]
_OLD = [
    *_XYZ, ("bits", "u1"), ("classification", "u1"), ("scan_angle", "i1"), ("user_data", "u1"),
    ("point_source_id", "<u2"),
]
_NEW = [
    *_XYZ, ("bits", "u1"), ("flags", "u1"), ("classification", "u1"), ("user_data", "u1"),
    ("scan_angle", "<i2"), ("point_source_id", "<u2"), ("gps_time", "<f8"),
]
_TIME = [("gps_time", "<f8")]
_RGB = [("red", "<u2"), ("green", "<u2"), ("blue", "<u2")]
_NIR = [("nir", "<u2")]
_WAVE = [("wave", "V29")]
FORMATS = {
    0: _OLD,
    1: _OLD + _TIME,
    2: _OLD + _RGB,
    3: _OLD + _TIME + _RGB,
    4: _OLD + _TIME + _WAVE,
    5: _OLD + _TIME + _RGB + _WAVE,
    6: _NEW,
    7: _NEW + _RGB,
    8: _NEW + _RGB + _NIR,
    9: _NEW + _WAVE,
    10: _NEW + _RGB + _NIR + _WAVE,
}
HEADER_SIZE = {(1, 2): 227, (1, 4): 375}
ANGLE = 0.006  # degrees a step, in formats 6 to 10

SCHEMA = (
    "file string, point_no long, x double, y double, z double, intensity int, "
    "return_number int, number_of_returns int, classification int, class_flags int, "
    "scanner_channel int, scan_direction int, edge_of_line int, scan_angle double, "
    "user_data int, point_source_id int, gps_time double, red int, green int, blue int, nir int"
)
_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "int": pa.int32()}
FIELDS = [tuple(f.strip().split(" ")) for f in SCHEMA.split(",")]
ARROW_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in FIELDS])


@dataclass(frozen=True)
class Header:
    version: tuple[int, int]
    offset: int
    format: int
    width: int
    count: int
    scale: tuple[float, float, float]
    shift: tuple[float, float, float]


def read_header(path: str) -> Header:
    size = file_size(path)
    raw = read_range(path, 0, min(375, size))
    if raw[:4] != b"LASF":
        raise ValueError(f"{path} is not a LAS file")
    version = (raw[24], raw[25])
    (offset,) = struct.unpack_from("<I", raw, 96)
    kind, width, count = struct.unpack_from("<BHI", raw, 104)
    numbers = struct.unpack_from("<6d", raw, 131)
    if version >= (1, 4):
        (count,) = struct.unpack_from("<Q", raw, 247)
    if kind not in FORMATS:
        raise ValueError(f"{path}: point format {kind} is compressed or unknown")
    if size < offset + count * width:
        raise ValueError(f"{path} ends before its {count} records do")
    return Header(version, offset, kind, width, count, numbers[:3], numbers[3:])


@dataclass
class ByteRanges(InputPartition):
    """Parts of files; a record belongs to the range that its first byte lies in."""

    ranges: list[tuple[str, int, int]]


class LasReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.records = int(options.get("records", RECORDS))

    def partitions(self) -> list[ByteRanges]:
        limit = self.records * SHORTEST
        sizes = list_sizes(self.path, (".las",))
        return [ByteRanges(own) for own in packed(sizes, limit, min(OPENING, limit))] or [ByteRanges([])]

    def read(self, partition: ByteRanges):
        for file, start, end in partition.ranges:
            header = read_header(file)
            first, last = (
                min(max(-((header.offset - at) // header.width), 0), header.count) for at in (start, end)
            )
            for at in range(first, last, BATCH):
                yield _batch(file, header, at, min(at + BATCH, last))


def _batch(file: str, header: Header, first: int, last: int) -> pa.RecordBatch:
    fields = FORMATS[header.format]
    width = np.dtype(fields).itemsize
    layout = np.dtype([*fields, ("extra", f"V{header.width - width}")])
    raw = read_range(file, header.offset + first * header.width, (last - first) * header.width)
    points = np.frombuffer(raw, layout)
    modern = header.format >= 6
    bits, classes = points["bits"], points["classification"]
    values = {
        "file": pa.array([file] * len(points)),
        "point_no": np.arange(first, last),
        **{
            name: points[name.upper()] * header.scale[i] + header.shift[i]
            for i, name in enumerate("xyz")
        },
    }
    if modern:
        flags = points["flags"]
        values |= {
            "return_number": bits & 15,
            "number_of_returns": bits >> 4,
            "class_flags": flags & 15,
            "scanner_channel": (flags >> 4) & 3,
            "scan_direction": (flags >> 6) & 1,
            "edge_of_line": flags >> 7,
            "scan_angle": points["scan_angle"] * ANGLE,
        }
    else:
        values |= {
            "return_number": bits & 7,
            "number_of_returns": (bits >> 3) & 7,
            "classification": classes & 31,
            "class_flags": classes >> 5,
            "scan_direction": (bits >> 6) & 1,
            "edge_of_line": bits >> 7,
            "scan_angle": points["scan_angle"].astype(np.float64),
        }
    for name, _ in FIELDS:
        if name not in values:
            known = name in points.dtype.names and (name != "scanner_channel" or modern)
            values[name] = points[name] if known else None
    columns = []
    for field in ARROW_SCHEMA:
        value = values[field.name]
        if value is None:
            columns.append(pa.nulls(len(points), field.type))
        else:
            columns.append(pa.array(value).cast(field.type))
    return pa.RecordBatch.from_arrays(columns, schema=ARROW_SCHEMA)


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[str]


#: What an attribute may hold at most, in the older formats and in the newer ones.
_LIMITS = {
    "intensity": (65535, 65535),
    "return_number": (7, 15),
    "number_of_returns": (7, 15),
    "classification": (31, 255),
    "class_flags": (7, 15),
    "scanner_channel": (0, 3),
    "scan_direction": (1, 1),
    "edge_of_line": (1, 1),
    "user_data": (255, 255),
    "point_source_id": (65535, 65535),
    **{name: (65535, 65535) for name in ("red", "green", "blue", "nir")},
}


class _Points:
    """Points gathered for one file, as plain columns, and whether an attribute was given at all."""

    def __init__(self, scale: np.ndarray, shift: np.ndarray) -> None:
        self.scale, self.shift = scale, shift
        self.parts: list[dict[str, np.ndarray]] = []
        self.given: set[str] = set()
        self.count = 0

    def add(self, batch: pa.RecordBatch) -> None:
        part: dict[str, np.ndarray] = {}
        for i, c in enumerate("xyz"):
            values = batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(values).all():
                raise ValueError(f"a point has no {c}")
            stored = np.rint((values - self.shift[i]) / self.scale[i])
            if np.abs(stored).max() >= 2**31:
                raise ValueError(f"{c} does not fit the LAS scale and offset given")
            part[c] = stored
        for name in ("scan_angle", "gps_time", *_LIMITS):
            values = batch.column(name) if name in batch.schema.names else None
            if values is None or values.null_count == len(values):
                default = 1.0 if name in ("return_number", "number_of_returns") else 0.0
                part[name] = np.full(len(batch), default)
                continue
            if values.null_count:
                raise ValueError(f"{name} is missing for some points of a file only")
            self.given.add(name)
            part[name] = values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = _LIMITS.get(name, (0, np.inf))[1]
            if name in _LIMITS and ((part[name] < 0) | (part[name] > top)).any():
                raise ValueError(f"{name} does not fit a LAS record")
        if "number_of_returns" not in self.given:
            part["number_of_returns"] = part["return_number"]
        self.parts.append(part)
        self.count += len(batch)

    def file(self) -> list[bytes]:
        """Header and records, in the oldest format that holds everything exactly."""
        p = {k: np.concatenate([part[k] for part in self.parts]) for k in self.parts[0]}
        angle, colour = p["scan_angle"], bool({"red", "green", "blue"} & self.given)
        modern = (
            any((p[name] > old).any() for name, (old, _) in _LIMITS.items())
            or "nir" in self.given
            or (np.rint(angle) != angle).any()
            or (np.abs(angle) > 127).any()
        )
        if modern:
            kind = 8 if "nir" in self.given else 7 if colour else 6
        else:
            kind = ("gps_time" in self.given) + 2 * colour
        records = np.zeros(self.count, np.dtype(FORMATS[kind]))
        whole = {name: p[name].astype(np.int64) for name in _LIMITS}
        for i, c in enumerate("xyz"):
            records[c.upper()] = p[c]
        for name in records.dtype.names:
            if name in ("intensity", "user_data", "point_source_id", "red", "green", "blue", "nir"):
                records[name] = whole[name]
        if "gps_time" in records.dtype.names:
            records["gps_time"] = p["gps_time"]
        turns = (whole["scan_direction"] << 6) | (whole["edge_of_line"] << 7)
        if modern:
            steps = np.rint(angle / ANGLE)
            if (np.abs(steps) > 32767).any() or (np.abs(steps * ANGLE - angle) > 0.0031).any():
                raise ValueError("scan_angle does not fit a LAS record")
            records["scan_angle"] = steps
            records["bits"] = whole["return_number"] | (whole["number_of_returns"] << 4)
            records["flags"] = whole["class_flags"] | (whole["scanner_channel"] << 4) | turns
            records["classification"] = whole["classification"]
        else:
            records["scan_angle"] = angle
            records["bits"] = whole["return_number"] | (whole["number_of_returns"] << 3) | turns
            records["classification"] = whole["classification"] | (whole["class_flags"] << 5)
        return [self._header(kind, records, whole["return_number"]), records.tobytes()]

    def _header(self, kind: int, records: np.ndarray, number: np.ndarray) -> bytes:
        version = (1, 4) if kind >= 6 else (1, 2)
        size = HEADER_SIZE[version]
        header = bytearray(size)
        header[0:4] = b"LASF"
        header[24:26] = bytes(version)
        header[26:32] = b"export"
        struct.pack_into("<HII", header, 94, size, size, 0)
        returns = np.bincount(np.clip(number, 1, 15), minlength=16)[1:16]
        old = (0,) * 6 if kind >= 6 else (self.count, *np.append(returns[:4], returns[4:].sum()))
        struct.pack_into("<BHI5I", header, 104, kind, records.dtype.itemsize, *old)
        struct.pack_into("<6d", header, 131, *self.scale, *self.shift)
        ends = []
        for i, c in enumerate("XYZ"):
            ends += [records[c].max() * self.scale[i] + self.shift[i]]
            ends += [records[c].min() * self.scale[i] + self.shift[i]]
        struct.pack_into("<6d", header, 179, *ends)
        if kind >= 6:
            struct.pack_into("<QIQ15Q", header, 227, 0, 0, 0, *[0] * 15)
            struct.pack_into("<Q15Q", header, 247, self.count, *returns)
            header[6:8] = struct.pack("<H", 16)  # the reference system is well-known text, if any
        return bytes(header)


class LasWriter(DataSourceArrowWriter):
    """LAS files, at least one per task with points; a new one every few million points.

    A file has the oldest record format that holds its attributes exactly: 0 to 3 (LAS 1.2) or 6 to
    8 (LAS 1.4). Values that no format holds are an error. Files appear when the job commits.
    """

    def __init__(self, options: dict[str, str], overwrite: bool = False) -> None:
        self.out = StagedFolder(options["path"], overwrite, (".las",))
        self.scale = np.full(3, float(options.get("scale", 0.001)))
        self.shift = np.array([float(options.get(f"offset_{c}", 0.0)) for c in "xyz"])

    def write(self, iterator) -> WrittenFiles:
        files: list[str] = []
        points = _Points(self.scale, self.shift)
        for batch in iterator:
            if batch.num_rows:
                points.add(batch)
            if points.count >= FILE_POINTS:
                files.append(self._finish(points))
                points = _Points(self.scale, self.shift)
        if points.count:
            files.append(self._finish(points))
        return WrittenFiles(files)

    def _finish(self, points: _Points) -> str:
        file = self.out.new_stem() + ".las"
        write_file(file, points.file())
        return file

    def commit(self, messages) -> None:
        self.out.commit([f for m in messages if m is not None for f in m.files])

    def abort(self, messages) -> None:
        self.out.discard()


class LasDataSource(DataSource):
    default_fs: str | None = None

    def _options(self) -> dict[str, str]:
        return {**self.options, "path": qualified(self.options["path"], self.default_fs)}

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> LasReader:
        return LasReader(self._options())

    def writer(self, schema: StructType, overwrite: bool) -> LasWriter:
        return LasWriter(self._options(), overwrite)
