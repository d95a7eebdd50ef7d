import os
import xml.etree.ElementTree as ET

import pytest
from skytrace.functions import geometry as g
from skytrace.operators import flights, photos, reports
from skytrace.plans import queries
from skytrace.sources import sinks
from skytrace.sources.text import numbered_lines, read_camera_logs, read_tracks


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read_parts(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            out += (path / name).read_text(encoding="utf-8").splitlines()
    return out


def test_lines_are_numbered_across_splits(spark, tmp_path, small_splits):
    for f in range(3):
        lines = [f"line {i} of file {f}" if i % 7 else "" for i in range(400 * f)]
        (tmp_path / f"log{f}.txt").write_text("\n".join(lines) + "\n" if lines else "")
    (tmp_path / "other.txt").write_text("no")
    for skip_blank in (False, True):
        rows = numbered_lines(spark, str(tmp_path), "log", skip_blank=skip_blank)
        got = {(r.file[-5], r.line_no): r.value for r in rows.collect()}
        want = {}
        for f in range(3):
            lines = (tmp_path / f"log{f}.txt").read_text().splitlines()
            lines = [v for v in lines if v or not skip_blank]
            want.update({(str(f), i): v for i, v in enumerate(lines, start=1)})
        assert got == want


def test_track_scan(spark, tmp_path, small_splits):
    nested = tmp_path / "day" / "one"
    nested.mkdir(parents=True)
    body = "".join(f"  {i} t {i}.5\t{i}.25   {100 + i} extra\n\n" for i in range(50))
    (nested / "GNSS_a.txt").write_text("h1 h2 h3 h4 h5 h6\n" + body)
    (tmp_path / "GNSS_narrow.txt").write_text("1 2 3 4\n")
    (tmp_path / "GNSS_ragged.txt").write_text("1 2 3 4 5\n1 2 3 4 5 6\n")
    (tmp_path / "GNSS_short.txt").write_text("1 2 3 4 5\n1 2 nan\n")
    scan = read_tracks(spark, str(tmp_path), "GNSS_", skip_rows=1)
    reasons = {os.path.basename(r.flight): r.reason for r in scan.rejects.collect()}
    assert reasons == {
        "GNSS_narrow.txt": "too_few_columns",
        "GNSS_ragged.txt": "row_longer_than_first",
    }
    rows = scan.track.orderBy("flight", "seq").collect()
    first = [r for r in rows if r.flight.endswith("GNSS_a.txt")]
    assert [(r.seq, r.x, r.y, r.z) for r in first] == [
        (i + 1, i + 0.5, i + 0.25, 100.0 + i) for i in range(50)
    ]
    (short,) = [r for r in rows if r.flight.endswith("short.txt")]
    assert (short.x, short.y, short.z) == (None, None, None)
    flat = read_tracks(spark, str(tmp_path), "GNSS_", recursive=False)
    assert {os.path.basename(r.flight) for r in flat.track.collect()} == {"GNSS_short.txt"}


def test_no_match_is_empty_and_no_folder_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2 3 4 5\n")
    assert read_tracks(spark, str(tmp_path), "zzz").track.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_tracks(spark, str(tmp_path / "missing"))


def test_camera_logs(spark, tmp_path):
    header = [f"header {i}" for i in range(6)]
    body = ["IMG_0001.jpg 19.1", "short", "", "12345678", "IMG_0005 x"]
    (tmp_path / "Camara_v1.txt").write_text("\n".join(header + body) + "\n")
    (tmp_path / "Camara_v1__.txt").write_text("an earlier output\n" * 9)
    out = photos.renumber_photos(read_camera_logs(spark, str(tmp_path)))
    got = [(r.photo_no, r.value) for r in out.orderBy("photo_no").collect()]
    assert got == [
        (1, "DSC00001.JPG.jpg 19.1"),
        (2, "short"),
        (3, ""),
        (4, "DSC00004.JPG"),
        (5, "DSC00005.JPG x"),
    ]
    sinks.write_camera_logs(out, str(tmp_path / "out"))
    (folder,) = (tmp_path / "out").rglob("output=Camara_v1__.txt")
    assert read_parts(folder) == [v for _, v in got]


def test_logs_of_equal_name_stay_apart(spark, tmp_path):
    rows = [(f"/d{k}/Camara_v1.txt", i, f"line {i} of {k}") for k in (1, 2) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "file string, photo_no long, value string")
    sinks.write_camera_logs(df, str(tmp_path / "out"))
    folders = sorted((tmp_path / "out").rglob("output=*"))
    assert [read_parts(f) for f in folders] == [
        [f"line {i} of {k}" for i in range(1, 40)] for k in (1, 2)
    ]


def chords(spark):
    rows = [
        (1, "N - S", [(0.0, 0.0), (0.0, 1500.0)], "a<b"),
        (2, "E - W", [(0.0, 0.0), (300.0, 400.0)], None),
    ]
    return spark.createDataFrame(
        rows, f"id int, direction string, coords {g.COORDS}, remark string"
    )


def test_volume_text(spark, tmp_path):
    sinks.write_text(reports.volume_text(chords(spark)), str(tmp_path / "v"))
    assert read_parts(tmp_path / "v") == [
        "Volumen de Obra:",
        "Linea 1: 1.500 km",
        "Linea 2: 0.500 km",
        "",
        "Total de Longitud en km: 2.000",
    ]


def test_kml_is_well_formed(spark, tmp_path):
    sinks.write_text(reports.lines_kml(chords(spark)), str(tmp_path / "k"))
    root = ET.fromstring("\n".join(read_parts(tmp_path / "k")))
    ns = {"k": "http://www.opengis.net/kml/2.2"}
    marks = root.findall(".//k:Placemark", ns)
    assert [m.find("k:name", ns).text for m in marks] == ["Linea 1", "Linea 2"]
    assert marks[0].find("k:description", ns).text == (
        "Dirección: N - S\nLongitud: 1.500 km\nremark: a<b"
    )
    assert marks[1].find("k:description", ns).text.endswith("remark: None")
    assert marks[1].find(".//k:coordinates", ns).text == "0.0,0.0 300.0,400.0"


def test_kml_coordinates_are_geographic(spark):
    utm = spark.createDataFrame(
        [(1, "N - S", [(500000.0, 4982950.4002), (500000.0, 0.0)])],
        f"id int, direction string, coords {g.COORDS}",
    )
    text = reports.kml_placemarks(utm, 32614).first().value
    first = text.split("<coordinates>")[1].split(" ")[0].split(",")
    assert float(first[0]) == pytest.approx(-99) and float(first[1]) == pytest.approx(45)


def test_area_texts(spark, tmp_path):
    areas = spark.createDataFrame([(1, 12345.6, 1.23456)], "project_id long, area_m2 double, area_ha double")
    sinks.write_text(reports.area_text(areas), str(tmp_path / "a"))
    assert read_parts(tmp_path / "a") == ["Área en km²: 12345.600", "Área en hectáreas: 1.235"]
    ring = spark.createDataFrame(
        [(1, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (1, 0), (1, 1), (0, 0)])],
        "project_id long, pos long, x double, y double",
    )
    sinks.write_text(reports.ring_kml(ring), str(tmp_path / "r"))
    root = ET.fromstring("\n".join(read_parts(tmp_path / "r")))
    assert root.find(".//coordinates").text.split() == ["0.0,0.0", "1.0,0.0", "1.0,1.0", "0.0,0.0"]


def test_flight_report_appends(spark, tmp_path):
    lines = spark.createDataFrame(
        [("file:/d/v2.txt", 1.25, "E - W"), ("file:/d/v1.txt", 2.0, "N - S")],
        "flight string, long_km double, direction string",
    )
    text = reports.flight_text(flights.flight_report(lines))
    for _ in range(2):
        sinks.write_text(text, str(tmp_path / "r"), append=True)
    rows = sinks.read_text(spark, str(tmp_path / "r")).orderBy("run", "line_no").collect()
    start = " y longitud total de líneas de producción "
    want = [
        f"Vuelo: v1 con dirección N - S{start}2.000 km",
        f"Vuelo: v2 con dirección E - W{start}1.250 km",
        "Total de todas las longitudes: 3.250 km",
    ]
    assert [(r.run, r.line_no, r.value) for r in rows] == [
        (run, i, value) for run in (1, 2) for i, value in enumerate(want, start=1)
    ]


def test_report_runs_of_several_parts_stay_in_order(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for run in "ab":
            df = spark.createDataFrame([(i, f"{run}{i}") for i in range(50)], "ord int, value string")
            sinks.write_text(df, str(tmp_path / "r"), append=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sinks.read_text(spark, str(tmp_path / "r")).orderBy("run", "line_no").collect()
    assert [r.value for r in rows] == [f"{run}{i}" for run in "ab" for i in range(50)]


def test_text_scans_store_nothing(spark, tmp_path, small_splits):
    (tmp_path / "GNSS_a.txt").write_text("".join(f"p {i} 1 2 3\n" for i in range(500)))
    folder = spark.sparkContext.getCheckpointDir()
    before = set(os.listdir(folder.removeprefix("file:"))) if folder else set()
    scan = read_tracks(spark, str(tmp_path), "GNSS_", columns=(1, 2, 3))
    assert sorted((r.seq, r.x) for r in scan.track.collect()) == [(i, float(i)) for i in range(500)]
    assert scan.rejects.count() == 0
    folder = spark.sparkContext.getCheckpointDir()
    assert before == (set(os.listdir(folder.removeprefix("file:"))) if folder else set())


def test_layers_keep_equal_names_apart(spark, tmp_path):
    df = spark.createDataFrame([("a/x.txt", 1), ("b/x.txt", 2)], "flight string, id int")
    sinks.write_layer(df, str(tmp_path / "layer"), by="flight")
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 2


def test_layouts_are_written_in_many_parts(spark):
    path = queries._layout_files(spark, "/root/testdata/sf0.001")
    rejects = read_tracks(spark, path, prefix="part-").rejects.collect()
    files = {n: os.listdir(os.path.join(path.removeprefix("file:"), f"layout={n}")) for n in range(3)}
    for reason, layout in (("too_few_columns", 1), ("row_longer_than_first", 2)):
        found = [r.flight for r in rejects if r.reason == reason]
        assert all(f"layout={layout}/" in f for f in found)
        assert len(found) == sum(f.startswith("part-") for f in files[layout]) > 1
    lines = spark.read.text(path).groupBy("value").count().collect()
    own = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["count"] for r in lines) == own + parts


def test_files_of_a_flight_follow_its_size(spark, tmp_path):
    import glob

    many = spark.range(200_000, numPartitions=16).selectExpr("'large' AS flight", "uuid() AS a")
    few = spark.range(16, numPartitions=16).selectExpr("concat('small', id % 4) AS flight", "uuid() AS a")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_layer(many.unionByName(few), str(tmp_path / "l"), by="flight")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {k: len(glob.glob(f"{tmp_path}/l/flight={k}/*.parquet")) for k in ("large", "small0", "small3")}
    assert files["small0"] == files["small3"] == 1
    assert 4 <= files["large"] <= 16
    assert spark.read.parquet(str(tmp_path / "l")).count() == 200_016


def test_decimals_are_those_of_the_exact_value(spark):
    import random

    from pyspark.sql import functions as F

    from skytrace.functions.text import fixed_decimals

    rng = random.Random(7)
    values = [1.0005, 0.0005, 0.0015, 2.5, -2.0005, 0.9995, 0.99949999, 999.9995, 1e-300, 5e-324, -0.0, 0.0]
    values += [2.0**53 + 2, 2.0**62, 1 / 16, 3 / 16, 1.0625, -0.0001, 123456789.0625, float("nan")]
    values += [float("inf"), -float("inf"), 2.0**43 + 2.0**-9, 0.5, 0.4995, 0.00049999999999999]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-6, 12) for _ in range(2000)]
    values += [rng.randrange(-(10**7), 10**7) / 2**rng.randrange(1, 12) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    for digits in (3, 1):
        got = [r[0] for r in df.select(fixed_decimals(F.col("v"), digits)).collect()]
        assert got == [f"{v:.{digits}f}" for v in values] + [None]


def test_missing_inputs_are_named(spark, tmp_path):
    from skytrace.sources.files import missing

    (tmp_path / "there.txt").write_text("x")
    paths = [str(tmp_path / "there.txt"), str(tmp_path), str(tmp_path / "gone"), f"file:{tmp_path}/lost"]
    assert [r.path for r in missing(spark, paths).collect()] == paths[2:]
    assert missing(spark, paths[:2]).count() == 0
