"""``shp``: ESRI shapefiles (points, lines, polygons) with their DBF attributes.

A feature is its attributes plus ``parts``, an array of vertex arrays: one part of one vertex for
a point, one part per piece of a line, one ring per part of a polygon. ``file``, ``record_no`` and
``srid`` (0 when the .prj is missing or unknown) are added on reading.

Reader options: ``path`` (file or folder), ``encoding`` of the attributes, ``records`` per
partition at most. The .shx index lets tasks read ranges of records on their own; ranges are made from
its size in the folder's listing. Without a schema the driver reads the attributes of all tables;
``read_layers`` has tasks do that.
Writer options: ``path`` (folder), ``kind`` (point, line or polygon), ``srid``, ``encoding``.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from skytrace.functions.crs import GEOGRAPHIC, WEB_MERCATOR, marked, utm_zone
from skytrace.sources import register
from skytrace.sources.files import (
    StagedFolder,
    concurrently,
    exists,
    list_files,
    list_sizes,
    packed,
    qualified,
    read_range,
    write_file,
)

RECORDS = 1 << 16
#: What opening a file counts for, in bytes of its index, when small files share a task.
OPENING = 1 << 12
BATCH = 1 << 12
TEXT_WIDTH = 254
FILE_BYTES = 1 << 28
#: What a task gathers for one shapefile in all, attributes and index included, before it is written.
HELD_BYTES = 1 << 26
RECORD_LIMIT = (1 << 31) - FILE_BYTES - (1 << 20)

# Shape type codes.
KINDS = {"point": 1, "line": 3, "polygon": 5}
POINT, LINE, POLYGON = (1, 11, 21), (3, 13, 23), (5, 15, 25)

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(VERTEX))
ADDED = [
    T.StructField("file", T.StringType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("srid", T.IntegerType()),
    T.StructField("parts", PARTS),
]
_ARROW_PARTS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


@dataclass(frozen=True)
class Table:
    """Layout of a DBF file: ``fields`` are (name, type letter, width, decimals)."""

    start: int
    width: int
    count: int
    fields: tuple[tuple[str, str, int, int], ...]


def read_table_layout(path: str, encoding: str) -> Table:
    head = read_range(path, 0, 32)
    count, start, width = struct.unpack_from("<IHH", head, 4)
    raw = read_range(path, 32, start - 32)
    fields = []
    for at in range(0, len(raw) - 31, 32):
        if raw[at] == 0x0D:
            break
        name = raw[at : at + 11].split(b"\0")[0].decode(encoding)
        fields.append((name, chr(raw[at + 11]), raw[at + 16], raw[at + 17]))
    return Table(start, width, count, tuple(fields))


def _spark_type(letter: str, width: int, decimals: int) -> T.DataType:
    if letter == "L":
        return T.BooleanType()
    if letter in "NF":
        return T.LongType() if decimals == 0 and letter == "N" and width <= 18 else T.DoubleType()
    return T.StringType()


def _sibling(shp: str, extension: str) -> str:
    return shp[: -len(".shp")] + extension


def _encoding(shp: str, chosen: str | None) -> str:
    if chosen:
        return chosen
    page = _sibling(shp, ".cpg")
    if exists(page):
        return read_range(page, 0, 64).decode("ascii").strip() or "utf-8"
    return "utf-8"


def _srid(shp: str) -> int:
    prj = _sibling(shp, ".prj")
    if not exists(prj):
        return 0
    text = read_range(prj, 0, 1 << 16).decode("utf-8", "replace")
    zone = re.search(r"WGS[_ ](?:19)?84[^\"]*UTM[_ ]zone[_ ](\d{1,2})([NS])", text, re.IGNORECASE)
    if zone:
        return (32600 if zone[2].upper() == "N" else 32700) + int(zone[1])
    if text.startswith("GEOGCS") and re.search(r"WGS[_ ](19)?84", text):
        return GEOGRAPHIC
    return WEB_MERCATOR if "Mercator_Auxiliary_Sphere" in text or "3857" in text else 0


def projection_text(srid: int) -> str | None:
    """Well-known text of the supported reference systems, for .prj files."""
    geographic = (
        'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],'
        'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
    )
    if srid == GEOGRAPHIC:
        return geographic
    if srid == WEB_MERCATOR:
        return (
            f'PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere",{geographic},'
            'PROJECTION["Mercator_Auxiliary_Sphere"],UNIT["Meter",1.0]]'
        )
    if utm_zone(srid) is None:
        return None
    zone, south = utm_zone(srid)
    return (
        f'PROJCS["WGS_1984_UTM_Zone_{zone}{"S" if south else "N"}",{geographic},'
        'PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",500000.0],'
        f'PARAMETER["False_Northing",{10000000.0 if south else 0.0}],'
        f'PARAMETER["Central_Meridian",{float(zone * 6 - 183)}],PARAMETER["Scale_Factor",0.9996],'
        'PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'
    )


@dataclass
class RecordRanges(InputPartition):
    """Records of files, as ranges of bytes in their index (8 bytes each after the header)."""

    ranges: list[tuple[str, int, int]]


class ShapefileReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.path = options["path"]
        self.records = int(options.get("records", RECORDS))
        self.encoding = options.get("encoding")
        self.fields = [f for f in schema.fields if f.name not in {a.name for a in ADDED}]

    def partitions(self) -> list[RecordRanges]:
        if self.path.lower().endswith(".shp"):
            index = _sibling(self.path, ".shx")
            sizes = {self.path: list_sizes(index, (".shx",))[index]}
        else:
            listed = list_sizes(self.path, (".shp", ".shx"))
            by_name = {name.lower(): size for name, size in listed.items()}
            sizes = {f: by_name[f.lower()[:-4] + ".shx"] for f in listed if f.lower().endswith(".shp")}
        sizes = {file: size - 100 for file, size in sizes.items()}
        limit = 8 * self.records
        return [RecordRanges(own) for own in packed(sizes, limit, min(OPENING, limit))] or [RecordRanges([])]

    def read(self, partition: RecordRanges):
        for file, start, end in partition.ranges:
            yield from self._records(file, start // 8, end // 8)

    def _records(self, file: str, start: int, end: int):
        encoding = _encoding(file, self.encoding)
        table = read_table_layout(_sibling(file, ".dbf"), encoding)
        srid = _srid(file)
        for first in range(start, end, BATCH):
            last = min(first + BATCH, end)
            index = np.frombuffer(
                read_range(_sibling(file, ".shx"), 100 + 8 * first, 8 * (last - first)), ">i4"
            ).reshape(-1, 2).astype(np.int64) * 2
            low = int(index[0, 0])
            high = int((index[:, 0] + index[:, 1]).max()) + 8
            raw = read_range(file, low, high - low)
            parts = _shapes(raw, index[:, 0] - low + 8)
            kept, columns = _attributes(file, table, first, last, encoding)
            n = last - first
            arrays = []
            for field in self.fields:
                kind = _arrow_type(field.dataType)
                values = columns.get(field.name)
                arrays.append(pa.nulls(n, kind) if values is None else values.cast(kind))
            arrays += [
                pa.array([file] * n, pa.string()),
                pa.array(range(first, last), pa.int64()),
                pa.array([srid] * n, pa.int32()),
                parts,
            ]
            names = [f.name for f in self.fields] + [a.name for a in ADDED]
            yield pa.RecordBatch.from_arrays(arrays, names).filter(pa.array(kept))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()
    }.get(kind.simpleString(), pa.string())


def _shapes(raw: bytes, places: np.ndarray) -> pa.Array:
    """The parts of the records at ``places`` as one nested Arrow array."""
    kinds = [struct.unpack_from("<i", raw, int(at))[0] for at in places]
    vertices, part_sizes, part_counts = [], [], []
    for at, kind in zip(places.tolist(), kinds, strict=True):
        if kind in POINT:
            sizes, count, begin = np.ones(1, np.int64), 1, at + 4
        elif kind in LINE or kind in POLYGON:
            parts, count = struct.unpack_from("<2i", raw, at + 36)
            starts = np.frombuffer(raw, "<i4", parts, at + 44)
            sizes, begin = np.diff(np.append(starts, count)), at + 44 + 4 * parts
        elif kind == 0:
            sizes, count, begin = np.zeros(0, np.int64), 0, at
        else:
            raise ValueError(f"shape type {kind} is not supported")
        vertices.append(np.frombuffer(raw, "<f8", 2 * count, begin))
        part_sizes.append(sizes)
        part_counts.append(len(sizes))
    flat = np.concatenate(vertices).reshape(-1, 2)
    points = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(flat[:, i])) for i in (0, 1)], ["x", "y"]
    )
    inner = np.append(0, np.cumsum(np.concatenate(part_sizes)))
    outer = np.append(0, np.cumsum(part_counts))
    lists = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), points)
    empty = np.append([kind == 0 for kind in kinds], False)  # a null shape
    offsets = pa.array(outer, pa.int32(), mask=empty)
    return pa.ListArray.from_arrays(offsets, lists).cast(_ARROW_PARTS)


def _attributes(
    file: str, table: Table, first: int, last: int, encoding: str
) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Which records are not marked as deleted, and the columns of all."""
    raw = read_range(
        _sibling(file, ".dbf"), table.start + first * table.width, (last - first) * table.width
    )
    records = np.frombuffer(raw, np.uint8).reshape(-1, table.width)
    columns, at = {}, 1
    for name, letter, width, decimals in table.fields:
        kind = _spark_type(letter, width, decimals)
        cells = np.ascontiguousarray(records[:, at : at + width]).view(f"S{width}").ravel()
        columns[name] = _column(cells, kind, encoding)
        at += width
    return records[:, 0] != ord("*"), columns


def _column(cells: np.ndarray, kind: T.DataType, encoding: str) -> pa.Array:
    """A DBF column from its cells of fixed width; blank cells are NULL."""
    if isinstance(kind, T.StringType):
        text = np.char.decode(np.char.rstrip(cells, b" \0"), encoding)
        return pa.array(text.astype(object), pa.string(), mask=text == "")
    cells = np.char.strip(cells, b" \0*")
    blank = cells == b""
    if isinstance(kind, T.BooleanType):
        upper = np.char.upper(cells)
        true = (upper == b"T") | (upper == b"Y")
        return pa.array(true, mask=~(true | (upper == b"F") | (upper == b"N")))
    if isinstance(kind, T.LongType):
        try:
            return pa.array(np.where(blank, b"0", cells).astype(np.int64), mask=blank)
        except ValueError:  # written as a decimal
            pass
    numbers = np.where(blank, b"0", cells).astype(np.float64)
    whole = isinstance(kind, T.LongType)
    return pa.array(numbers.astype(np.int64) if whole else numbers, mask=blank)


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[str]


class _OpenFile:
    """Records gathered for one shapefile."""

    def __init__(self) -> None:
        self.shapes: list[bytes] = []
        self.index: list[bytes] = []
        self.rows: list[bytes] = []
        self.count = 0
        self.size = 100
        self.held = 0
        self.low, self.high = np.full(2, np.inf), np.full(2, -np.inf)


class ShapefileWriter(DataSourceArrowWriter):
    """At least one shapefile per task with rows, and a new one before a file grows too large.

    Text longer than a DBF field or a feature beyond the format's limit is an error, never cut.
    """

    def __init__(
        self, options: dict[str, str], schema: T.StructType, overwrite: bool = False
    ) -> None:
        extensions = (".shp", ".shx", ".dbf", ".cpg", ".prj")
        self.out = StagedFolder(options["path"], overwrite, extensions)
        self.kind = KINDS[options.get("kind", "line")]
        self.srid = int(options.get("srid", 0))
        self.encoding = options.get("encoding", "utf-8")
        self.fields = [
            (f.name, *self._layout(f.dataType)) for f in schema.fields if f.name != "parts"
        ]
        for name, *_ in self.fields:
            if len(name.encode(self.encoding)) > 10:
                raise ValueError(f"field name {name!r} is too long for a DBF table")

    @staticmethod
    def _layout(kind: T.DataType) -> tuple[str, int, int]:
        if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            return "N", 18, 0
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return "F", 24, 15
        if isinstance(kind, T.BooleanType):
            return "L", 1, 0
        return "C", TEXT_WIDTH, 0

    def _cells(self, values: pa.Array, letter: str, width: int) -> np.ndarray:
        """A column's cells of fixed width, one row of bytes each; NULL is blank."""
        missing = np.asarray(values.is_null())
        if letter == "C":
            cells = [str(v).encode(self.encoding) for v in values.fill_null("").to_pylist()]
        elif letter == "L":
            cells = np.where(np.asarray(values.fill_null(False)), b"T", b"F")
        else:
            whole = letter == "N"
            kind = pa.int64() if whole else pa.float64()
            cells = np.asarray(values.cast(kind).fill_null(0 if whole else 0.0)).astype("S32")
            cells = np.char.rjust(cells, width)
        cells = np.asarray(cells, np.bytes_)
        if len(cells) and np.char.str_len(cells).max() > width:
            longest = values[int(np.char.str_len(cells).argmax())].as_py()
            raise ValueError(f"{longest!r} does not fit a field of {width} bytes")
        out = np.char.ljust(cells, width).astype(f"S{width}")
        out[missing] = b" " * width
        return out.view(np.uint8).reshape(len(out), width)

    def write(self, iterator) -> WrittenFiles:
        files: list[str] = []
        out = _OpenFile()
        row = 8 + self._row_width()  # of the index and of the table
        for batch in iterator:
            shapes = self._sizes(batch.column("parts"))
            limits = ((np.cumsum(shapes), "size", FILE_BYTES), (np.cumsum(shapes + row), "held", HELD_BYTES))
            start = 0
            while start < len(batch):  # a slice at a time, so that a file is closed in time
                end = len(batch)
                for sizes, name, limit in limits:
                    before = int(sizes[start - 1]) if start else 0
                    room = before + max(limit - getattr(out, name), 1)
                    end = min(end, max(int(np.searchsorted(sizes, room, "left")) + 1, start + 1))
                self._add(out, batch.slice(start, end - start))
                start = end
                if out.size >= FILE_BYTES or out.held >= HELD_BYTES:
                    files += self._finish(out)
                    out = _OpenFile()
        if out.count:
            files += self._finish(out)
        return WrittenFiles(files)

    def _sizes(self, parts: pa.Array) -> np.ndarray:
        """Bytes of the records, their own headers included."""
        counts = np.asarray(parts.value_lengths().fill_null(0), np.int64)
        vertices = np.append(0, np.cumsum(np.asarray(parts.flatten().value_lengths().fill_null(0), np.int64)))
        ends = np.cumsum(counts)
        points = vertices[ends] - vertices[ends - counts]
        if self.kind == KINDS["point"]:
            return np.where(points > 0, 28, 12)
        body = np.where(counts > 0, 44 + 4 * counts + 16 * points, 4)
        if len(body) and body.max() > RECORD_LIMIT:
            raise ValueError("a feature is too large for a shapefile record")
        return body + 8

    def _add(self, out: _OpenFile, batch: pa.RecordBatch) -> None:
        """Append the records of a batch, put together as columns of 32-bit words."""
        parts = batch.column("parts")
        words = self._sizes(parts) // 4
        at = np.cumsum(words) - words
        raw = np.zeros(int(words.sum()), "<u4")

        def put(place: np.ndarray, values: np.ndarray, kind: str) -> None:
            raw[place] = np.ascontiguousarray(values.astype(kind)).view("<u4")

        def put_doubles(place: np.ndarray, values: np.ndarray) -> None:
            """Rows of doubles from ``place`` on; a double takes two words."""
            own = np.ascontiguousarray(values, "<f8").view("<u4").reshape(len(values), -1)
            raw[place[:, None] + np.arange(own.shape[1])] = own

        put(at, np.arange(out.count + 1, out.count + 1 + len(batch)), ">i4")
        put(at + 1, words * 2 - 4, ">i4")
        counts = np.asarray(parts.value_lengths().fill_null(0), np.int64)
        rings = parts.flatten()
        ring_sizes = np.asarray(rings.value_lengths().fill_null(0), np.int64)
        flat = rings.flatten()
        xy = np.stack([np.asarray(c, np.float64) for c in flat.flatten()], 1)
        ring_ends = np.cumsum(counts)
        vertex = np.append(0, np.cumsum(ring_sizes))
        first, points = vertex[ring_ends - counts], vertex[ring_ends] - vertex[ring_ends - counts]
        full = np.flatnonzero(points > 0 if self.kind == KINDS["point"] else counts > 0)
        put(at[full] + 2, np.full(len(full), self.kind), "<i4")
        if self.kind == KINDS["point"]:
            xy = xy[first[full]]
            put_doubles(at[full] + 3, xy)
        elif len(full):
            if not points[full].all():
                raise ValueError("a feature has parts but no vertex")
            low, high = (f.reduceat(xy, first[full]) for f in (np.minimum, np.maximum))
            put_doubles(at[full] + 3, np.hstack([low, high]))
            put(at[full] + 11, counts[full], "<i4")
            put(at[full] + 12, points[full], "<i4")
            owner = np.repeat(np.arange(len(batch)), counts)
            begin = ring_ends - counts
            put(at[owner] + 13 + np.arange(len(owner)) - begin[owner], vertex[:-1] - first[owner], "<i4")
            owner = np.repeat(np.arange(len(batch)), points)
            place = at[owner] + 13 + counts[owner] + 4 * (np.arange(len(owner)) - first[owner])
            put_doubles(place, xy)
        if len(xy):
            out.low, out.high = np.minimum(out.low, xy.min(0)), np.maximum(out.high, xy.max(0))
        index = np.stack([out.size // 2 + at * 2, words * 2 - 4], 1)
        out.index.append(index.astype(">i4").tobytes())
        out.shapes.append(raw.tobytes())
        out.size += 4 * len(raw)
        out.count += len(batch)
        columns = [np.full((len(batch), 1), ord(" "), np.uint8)]
        columns += [self._cells(batch.column(n), letter, w) for n, letter, w, _ in self.fields]
        out.rows.append(np.hstack(columns).tobytes())
        out.held += len(out.shapes[-1]) + len(out.index[-1]) + len(out.rows[-1])

    def _finish(self, out: _OpenFile) -> list[str]:
        stem = self.out.new_stem()
        box = (*out.low, *out.high) if np.isfinite(out.low).all() else (0.0,) * 4
        outputs = {
            ".shp": [self._main_header(out.size, box), *out.shapes],
            ".shx": [self._main_header(100 + 8 * out.count, box), *out.index],
            ".dbf": [self._table_header(out.count), *out.rows, b"\x1a"],
            ".cpg": [self.encoding.encode("ascii")],
        }
        projection = projection_text(self.srid)
        if projection:
            outputs[".prj"] = [projection.encode()]
        for extension, chunks in outputs.items():
            write_file(stem + extension, chunks)
        return [stem + extension for extension in outputs]

    def _main_header(self, size: int, box: tuple) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack(
            "<2i8d", 1000, self.kind, *box, 0.0, 0.0, 0.0, 0.0
        )

    def _row_width(self) -> int:
        return 1 + sum(w for _, _, w, _ in self.fields)

    def _table_header(self, count: int) -> bytes:
        width = self._row_width()
        start = 33 + 32 * len(self.fields)
        head = struct.pack("<4BIHH20x", 3, 95, 7, 26, count, start, width)
        for name, letter, w, decimals in self.fields:
            head += struct.pack(
                "<11sc4xBB14x", name.encode(self.encoding), letter.encode(), w, decimals
            )
        return head + b"\r"

    def commit(self, messages) -> None:
        self.out.commit([f for m in messages if m is not None for f in m.files])

    def abort(self, messages) -> None:
        self.out.discard()


class ShapefileDataSource(DataSource):
    default_fs: str | None = None

    def _options(self) -> dict[str, str]:
        return {**self.options, "path": qualified(self.options["path"], self.default_fs)}

    @classmethod
    def name(cls) -> str:
        return "shp"

    def schema(self) -> T.StructType:
        """Attributes of all layers by name, in the order first met, then the added columns."""
        fields: dict[str, T.StructField] = {}
        chosen = self.options.get("encoding")

        def layout_of(file: str) -> Table:
            return read_table_layout(_sibling(file, ".dbf"), _encoding(file, chosen))

        files = list_files(self._options()["path"], ".shp")
        for layout in concurrently(layout_of, files):
            for name, letter, width, decimals in layout.fields:
                kind = _spark_type(letter, width, decimals)
                fields.setdefault(name, T.StructField(name, kind))
        return T.StructType([*fields.values(), *ADDED])

    def reader(self, schema: T.StructType) -> ShapefileReader:
        return ShapefileReader(self._options(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> ShapefileWriter:
        return ShapefileWriter(self._options(), schema, overwrite)


_FIELDS = "file string, place int, name string, letter string, width int, decimals int, srid int"


def _layouts(encoding: str | None):
    """mapInArrow function from file names to the attributes of their tables."""

    def run(batches):
        for batch in batches:
            rows = []
            for file in batch.column(0).to_pylist():
                srid = _srid(file)
                table = read_table_layout(_sibling(file, ".dbf"), _encoding(file, encoding))
                rows += [(file, i, *field, srid) for i, field in enumerate(table.fields)]
                rows.append((file, -1, None, None, None, None, srid))
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), *[pa.int32()] * 3]
            names = [x.split()[0] for x in _FIELDS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return run


def read_layers(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The layers at ``path`` by name of attribute, as the ``shp`` format reads them.

    Tasks read the tables' headers and projections; the driver gets a row for each name and for each
    reference system. Where all layers share a known one, ``parts`` is marked with it
    (``crs.srid_of``); where they don't, every row still tells its own in ``srid``.
    """
    register(spark)
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    files = list_files(qualified(path, default), ".shp")
    if not files:
        return spark.createDataFrame([], T.StructType(ADDED))
    names = spark.createDataFrame([(f,) for f in files], "file string")
    tasks = max(1, min(len(files) // 16, 10_000))
    found = names.repartition(tasks, "file").mapInArrow(_layouts(options.get("encoding")), _FIELDS)
    first = F.struct("file", "place", "letter", "width", "decimals")
    rows = (  # two rows a name or reference system that occurs
        found.groupBy("name", F.when(F.col("name").isNull(), F.col("srid")).alias("srid"))
        .agg(F.min(first).alias("first"))
        .collect()
    )
    fields = sorted((r for r in rows if r["name"] is not None), key=lambda r: r["first"][:2])
    schema = T.StructType(
        [T.StructField(r["name"], _spark_type(*r["first"][2:])) for r in fields] + ADDED
    )
    layers = spark.read.format("shp").schema(schema).options(**options).load(path)
    srids = {r["srid"] for r in rows if r["name"] is None}
    return marked(layers, srids.pop(), "parts") if len(srids) == 1 and 0 not in srids else layers
