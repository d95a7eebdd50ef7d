import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytrace.sources import las, register, shapefile
from skytrace.sources.files import list_files, qualified


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    register(spark)


PARTS = "array<array<struct<x:double,y:double>>>"


def test_las_round_trip_in_ranges(spark, tmp_path):
    path = str(tmp_path / "cloud")
    points = spark.range(1000, numPartitions=3).select(
        (F.col("id") * 0.25 - 100).alias("x"),
        (F.col("id") % 7 * 1.5).alias("y"),
        F.lit(2200.125).alias("z"),
        (F.col("id") % 65536).cast("int").alias("intensity"),
        (F.col("id") % 5 + 1).cast("int").alias("return_number"),
        F.lit(5).alias("number_of_returns"),
        (F.col("id") * 0.5).alias("gps_time"),
        F.lit(40000).alias("red"),
    )
    points.write.format("las").mode("append").option("offset_x", 10).save(path)
    read = spark.read.format("las").option("records", 100).load(path)
    assert read.rdd.getNumPartitions() >= 10
    kept = ["x", "y", "z", "intensity", "return_number", "number_of_returns", "gps_time", "red"]
    rounded = [F.round(c, 6).alias(c) if c in "xyz" else c for c in kept]
    got = sorted(tuple(r) for r in read.select(*rounded).collect())
    assert got == sorted(tuple(r) for r in points.collect())
    assert read.filter("nir IS NOT NULL").count() == 0


def test_writers_start_new_files_in_time(monkeypatch, tmp_path):
    batch = pa.record_batch({c: pa.array(np.arange(50.0)) for c in "xyz"})
    monkeypatch.setattr(las, "FILE_POINTS", 100)
    writer = las.LasWriter({"path": str(tmp_path / "l")})
    done = writer.write(iter([batch] * 5))
    assert [las.read_header(f).count for f in done.files] == [100, 100, 50]
    assert list_files(str(tmp_path / "l"), ".las") == []  # not before the job commits
    writer.commit([done, None])
    assert len(list_files(str(tmp_path / "l"), ".las")) == 3
    shape = pa.record_batch({"parts": pa.array([[[{"x": 0.0, "y": 1.0}, {"x": 2.0, "y": 1.0}]]] * 4)})
    monkeypatch.setattr(shapefile, "FILE_BYTES", 300)
    fields = T.StructType([T.StructField("parts", shapefile.PARTS)])
    done = shapefile.ShapefileWriter({"path": str(tmp_path / "s")}, fields).write(iter([shape] * 2))
    assert sum(f.endswith(".shp") for f in done.files) > 1


def test_shapefiles_are_closed_by_all_that_is_held(monkeypatch, tmp_path):
    """A point takes 28 bytes, its index 8 and its text attribute 255: all of them are in memory."""
    n = 100
    parts = pa.array([[[{"x": float(i), "y": 1.0}]] for i in range(n)])
    batch = pa.record_batch({"parts": parts, "name": pa.array([str(i) for i in range(n)])})
    monkeypatch.setattr(shapefile, "HELD_BYTES", 10 * (28 + 8 + 255))
    fields = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("parts", shapefile.PARTS)]
    )
    writer = shapefile.ShapefileWriter({"path": str(tmp_path / "s"), "kind": "point"}, fields)
    done = writer.write(iter([batch.slice(0, 37), batch.slice(37)]))
    tables = [f for f in done.files if f.endswith(".dbf")]
    counts = [shapefile.read_table_layout(f, "utf-8").count for f in tables]
    assert counts == [10] * 10


def test_las_1_4_format_8(spark, tmp_path):
    layout = np.dtype([*las.FORMATS[8], ("tail", "V3")])
    records = np.zeros(10, layout)
    records["X"], records["Y"], records["Z"] = np.arange(10), 5, -7
    records["bits"] = 2 | (3 << 4)
    records["flags"] = 9 | (2 << 4) | (1 << 6)
    records["scan_angle"] = -3000
    records["classification"] = 70
    records["nir"] = 9
    header = bytearray(375)
    header[0:4] = b"LASF"
    header[24:26] = bytes((1, 4))
    struct.pack_into("<HII", header, 94, 375, 375, 0)
    struct.pack_into("<BHI", header, 104, 8, layout.itemsize, 0)
    struct.pack_into("<6d", header, 131, 0.01, 0.01, 0.01, 1000, 2000, 0)
    struct.pack_into("<Q", header, 247, 10)
    (tmp_path / "a.las").write_bytes(bytes(header) + records.tobytes())
    rows = spark.read.format("las").load(str(tmp_path)).orderBy("point_no").collect()
    assert len(rows) == 10
    r = rows[3]
    assert (round(r.x, 6), round(r.y, 6), round(r.z, 6)) == (1000.03, 2000.05, -0.07)
    assert (r.return_number, r.number_of_returns, round(r.scan_angle, 6)) == (2, 3, -18.0)
    assert (r.class_flags, r.scanner_channel, r.scan_direction, r.edge_of_line) == (9, 2, 1, 0)
    assert (r.classification, r.nir, r.point_no) == (70, 9, 3)


def test_las_rejects_what_it_cannot_hold(spark, tmp_path):
    far = spark.createDataFrame([(1e9, 0.0, 0.0)], "x double, y double, z double")
    with pytest.raises(Exception, match="does not fit"):
        far.write.format("las").mode("append").save(str(tmp_path / "o"))
    (tmp_path / "bad.las").write_bytes(b"nope" * 100)
    with pytest.raises(Exception, match="not a LAS file"):
        spark.read.format("las").load(str(tmp_path / "bad.las")).count()


def test_line_layer_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = [
        (1, "Dirección desconocida", 1.5, True, [[(0.0, 0.0), (1.0, 2.0)]]),
        (2, None, None, None, [[(5.0, 5.0), (6.0, 7.0)], [(8.0, 8.0), (9.0, 9.0), (9.5, 9.0)]]),
        (3, "E - W", -2.25e-9, False, None),
    ]
    df = spark.createDataFrame(
        rows, f"ID long, direccion string, long_km double, ok boolean, parts {PARTS}"
    ).repartition(1)
    df.write.format("shp").mode("append").option("kind", "line").option("srid", 32614).option(
        "encoding", "latin1"
    ).save(path)
    read = spark.read.format("shp").option("records", 2).load(path)
    assert [f.name for f in read.schema.fields[:4]] == ["ID", "direccion", "long_km", "ok"]
    got = {r.ID: r for r in read.collect()}
    for i, name, km, ok, parts in rows:
        r = got[i]
        assert (r.direccion, r.long_km, r.ok, r.srid) == (name, km, ok, 32614)
        plain = [[(v.x, v.y) for v in p] for p in r.parts] if r.parts else None
        assert plain == parts
    with pytest.raises(Exception, match="utf-8"):
        spark.read.format("shp").option("encoding", "utf-8").load(path).collect()


def test_points_and_polygons(spark, tmp_path):
    points = spark.createDataFrame([(1, [[(3.0, 4.0)]])], f"line_id int, parts {PARTS}")
    points.write.format("shp").mode("append").option("kind", "point").save(str(tmp_path / "p"))
    (row,) = spark.read.format("shp").load(str(tmp_path / "p")).collect()
    assert (row.line_id, row.parts[0][0].x, row.srid) == (1, 3.0, 0)
    ring = [(0.0, 0.0), (0.0, 9.0), (9.0, 9.0), (0.0, 0.0)]
    hole = [(1.0, 2.0), (2.0, 3.0), (1.0, 3.0), (1.0, 2.0)]
    area = spark.createDataFrame([([ring, hole],)], f"parts {PARTS}").withColumn("n", F.lit("a"))
    area.write.format("shp").mode("append").option("kind", "polygon").option("srid", 4326).save(
        str(tmp_path / "a")
    )
    (row,) = spark.read.format("shp").load(str(tmp_path / "a")).collect()
    assert [[(v.x, v.y) for v in p] for p in row.parts] == [ring, hole] and row.srid == 4326


def test_layers_of_a_folder_are_united_by_name(spark, tmp_path):
    path = str(tmp_path / "u")
    for k, column in enumerate(["a", "b"]):
        row = (k, f"v{k}", [[(0.0, 0.0), (1.0, 1.0)]])
        df = spark.createDataFrame([row], f"id int, {column} string, parts {PARTS}")
        df.repartition(1).write.format("shp").mode("append").save(path)
    got = {(r.id, r.a, r.b) for r in spark.read.format("shp").load(path).collect()}
    assert got == {(0, "v0", None), (1, None, "v1")}
    assert len(list_files(path, ".shp")) == 2


def test_text_is_never_cut(spark, tmp_path):
    df = spark.createDataFrame([("x" * 300, [[(0.0, 0.0), (1.0, 1.0)]])], f"name string, parts {PARTS}")
    with pytest.raises(Exception, match="does not fit"):
        df.write.format("shp").mode("append").save(str(tmp_path / "t"))


def test_las_flags_of_old_formats(spark, tmp_path):
    records = np.zeros(1, np.dtype(las.FORMATS[0]))
    records["classification"] = 2 | 4 << 5  # ground, withheld
    records["bits"] = 1 | 2 << 3 | 1 << 6
    records["scan_angle"] = -12
    header = bytearray(227)
    header[0:4] = b"LASF"
    header[24:26] = bytes((1, 2))
    struct.pack_into("<HII", header, 94, 227, 227, 0)
    struct.pack_into("<BHI", header, 104, 0, records.dtype.itemsize, 1)
    struct.pack_into("<6d", header, 131, 0.01, 0.01, 0.01, 0, 0, 0)
    (tmp_path / "a.las").write_bytes(bytes(header) + records.tobytes())
    (r,) = spark.read.format("las").load(str(tmp_path)).collect()
    assert (r.classification, r.class_flags, r.scan_angle) == (2, 4, -12.0)
    assert (r.return_number, r.number_of_returns, r.scan_direction, r.edge_of_line) == (1, 2, 1, 0)


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        ({}, 0),
        ({"gps_time": 1.5}, 1),
        ({"red": 9}, 2),
        ({"gps_time": 1.5, "red": 9}, 3),
        ({"return_number": 9, "number_of_returns": 12}, 6),
        ({"classification": 200}, 6),
        ({"scan_angle": 12.006}, 6),
        ({"class_flags": 8, "red": 3}, 7),
        ({"nir": 5, "scanner_channel": 3}, 8),
    ],
)
def test_las_takes_the_format_that_holds_the_values(spark, tmp_path, values, kind):
    row = {"x": 1.0, "y": 2.0, "z": 3.0, **values}
    path = str(tmp_path / "o")
    types = {"gps_time": "double", "scan_angle": "double"}
    schema = ", ".join(f"{n} {types.get(n, 'double' if n in 'xyz' else 'int')}" for n in row)
    spark.createDataFrame([tuple(row.values())], schema).write.format("las").mode("append").save(path)
    (file,) = list_files(path, ".las")
    assert las.read_header(file).format == kind
    (read,) = spark.read.format("las").load(path).collect()
    assert all(abs(read[n] - v) < 1e-6 for n, v in row.items())


@pytest.mark.parametrize(
    "values", [{"return_number": 16}, {"classification": 300}, {"scan_angle": 5000.0}, {"x": None}]
)
def test_las_refuses_values_that_no_format_holds(tmp_path, values):
    row = {"x": 1.0, "y": 2.0, "z": 3.0, **values}
    batch = pa.record_batch({n: pa.array([v], pa.float64()) for n, v in row.items()})
    with pytest.raises(ValueError):
        las.LasWriter({"path": str(tmp_path)}).write(iter([batch]))


@pytest.mark.parametrize("kind", ["las", "shp"])
def test_overwrite_replaces_and_failed_jobs_leave_nothing(spark, tmp_path, kind):
    path = str(tmp_path / "o")
    if kind == "las":
        df = spark.range(10).selectExpr("id * 1.0D AS x", "0D AS y", "0D AS z")
        bad = df.selectExpr("x", "y", "IF(x > 8, 1e300D, z) AS z")
    else:
        df = spark.createDataFrame([(i, "a", [[(0.0, 0.0), (1.0, 1.0)]]) for i in range(10)],
                                   f"id int, name string, parts {PARTS}")
        bad = df.withColumn("name", F.when(F.col("id") > 8, F.repeat("name", 999)).otherwise("b"))
    for mode in ("append", "overwrite"):
        df.write.format(kind).mode(mode).save(path)
    assert spark.read.format(kind).load(path).count() == 10
    df.write.format(kind).mode("append").save(path)
    assert spark.read.format(kind).load(path).count() == 20
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="does not fit"):
            bad.repartition(4).write.format(kind).mode(mode).save(path)
    assert spark.read.format(kind).load(path).count() == 20


def test_deleted_records_are_not_read(spark, tmp_path):
    path = tmp_path / "o"
    df = spark.createDataFrame(
        [(i, [[(float(i), 0.0), (1.0, 1.0)]]) for i in range(3)], f"id int, parts {PARTS}"
    )
    df.repartition(1).write.format("shp").mode("append").save(str(path))
    (table,) = path.glob("*.dbf")
    raw = bytearray(table.read_bytes())
    start, width = struct.unpack_from("<HH", raw, 8)
    raw[start + width] = ord("*")
    table.write_bytes(bytes(raw))
    assert {r.id for r in spark.read.format("shp").load(str(path)).collect()} == {0, 2}


def test_paths_without_a_scheme_are_those_of_spark():
    assert qualified("/a/b", "hdfs://h:1") == "hdfs://h:1/a/b"
    assert qualified("/a/b", "file:///") == "/a/b"
    assert qualified("s3a://b/c", "hdfs://h:1") == "s3a://b/c"


def test_ten_thousand_files_are_planned_from_the_listing(monkeypatch):
    sizes = {f"/c/{i:05}.las": 227 + 34 * (i % 7) for i in range(10_000)} | {"/c/large.las": 1 << 28}

    def opened(*_):
        raise AssertionError("a file was opened")

    for name in ("read_header", "read_range", "file_size"):
        monkeypatch.setattr(las, name, opened)
    monkeypatch.setattr(las, "list_sizes", lambda path, suffixes: sizes)
    parts = las.LasReader({"path": "/c"}).partitions()
    held = [r for p in parts for r in p.ranges]
    assert len(parts) < 200 and len(held) == 10_000 + -(-(1 << 28) // (las.RECORDS * 20))
    assert sorted({f for f, _, _ in held}) == sorted(sizes)
    assert max(sum(b - a for _, a, b in p.ranges) for p in parts) <= las.RECORDS * 20

    monkeypatch.setattr(shapefile, "read_range", opened)
    index = {f"/s/{i:05}{e}": 100 + 8 * (i % 5) for i in range(10_000) for e in (".shp", ".shx")}
    monkeypatch.setattr(shapefile, "list_sizes", lambda path, suffixes: index)
    fields = T.StructType(shapefile.ADDED)
    parts = shapefile.ShapefileReader({"path": "/s"}, fields).partitions()
    held = [r for p in parts for r in p.ranges]
    assert len(held) == 8_000 and sum(b - a for _, a, b in held) == 8 * 20_000


def test_small_and_cut_las_files(spark, tmp_path):
    path = str(tmp_path / "many")
    cloud = spark.range(300, numPartitions=30).selectExpr("id * 1.0D AS x", "0.0D AS y", "0.0D AS z")
    cloud.write.format("las").mode("append").save(path)
    read = spark.read.format("las").load(path)
    assert read.rdd.getNumPartitions() == 1  # thirty small files share a task
    assert sorted(r.x for r in read.select("x").collect()) == [float(i) for i in range(300)]
    for records in (1, 3, 7):
        some = spark.read.format("las").option("records", records).load(path)
        assert sorted(r.x for r in some.select("x").collect()) == [float(i) for i in range(300)]
    file = list_files(path, ".las")[0]
    with open(file, "r+b") as f:
        f.truncate(240)
    with pytest.raises(Exception, match="ends before"):
        spark.read.format("las").load(path).count()


def test_layers_are_described_by_tasks(spark, tmp_path, monkeypatch):
    from skytrace.functions.crs import srid_of

    path = str(tmp_path / "layers")
    line = "array(array(named_struct('x', 0.0D, 'y', id * 1.0D), named_struct('x', 2.0D, 'y', 0.0D)))"
    for i, srid in enumerate((32614, 32614)):
        layer = spark.range(5).selectExpr(f"id AS n{i}", "'dirección' AS name", f"{line} AS parts")
        layer.write.format("shp").mode("append").options(kind="line", srid=srid).save(path)
    read = shapefile.read_layers(spark, path)
    assert {"n0", "n1", "name"} < set(read.columns) and srid_of(read) == 32614
    assert read.filter("n0 IS NOT NULL").count() == read.filter("n1 IS NOT NULL").count() == 5
    assert {r.name for r in read.collect()} == {"dirección"}
    layer.write.format("shp").mode("append").options(kind="line", srid=3857).save(path)
    mixed = shapefile.read_layers(spark, path)
    assert srid_of(mixed) is None and {r.srid for r in mixed.collect()} == {32614, 3857}
    (tmp_path / "none").mkdir()
    assert shapefile.read_layers(spark, str(tmp_path / "none")).count() == 0


def test_written_records_of_every_shape(spark, tmp_path):
    kind = f"id long, ok boolean, v double, name string, parts {PARTS}"
    line, other = [(0.0, 0.0), (3.0, -4.0)], [(9.5, 9.0), (9.0, 8.0), (7.0, 1e9)]
    rows = [
        (1, True, 0.1, "a", [line]),
        (None, None, None, None, None),
        (-5, False, -1e300, "é" * 127, [line, other]),
        (7, True, 5e-324, " b", [other[:1]]),
        (8, False, 0.0, "", []),
    ]
    path = str(tmp_path / "s")
    spark.createDataFrame(rows, kind).coalesce(1).write.format("shp").mode("append").save(path)
    read = spark.read.format("shp").load(path).orderBy("record_no").collect()
    got = [(r.id, r.ok, r.v, r.name, r.parts and [[tuple(v) for v in p] for p in r.parts]) for r in read]
    rows[4] = (8, False, 0.0, None, None)  # blank text and shapes without parts are NULL
    assert got == rows
