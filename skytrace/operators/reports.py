"""Reports and KML as ordered rows of text.

Each function returns ``(ord ..., value)`` rows; ``skytrace.sources.sinks.write_text`` sorts them
across the cluster and writes the parts in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.functions import geometry as g
from skytrace.functions.crs import GEOGRAPHIC, reproject_coords
from skytrace.functions.text import file_stem, kilometres, xml_escaped
from skytrace.operators.lines import volume_report, with_length_km

# The wording of the reports.
VOLUME_TITLE = "Volumen de Obra:"
VOLUME_LINE = "Linea "
VOLUME_TOTAL = "Total de Longitud en km: "
AREA_KM2 = "Área en km²: "
AREA_HA = "Área en hectáreas: "
FLIGHT = "Vuelo: "
FLIGHT_DIRECTION = " con dirección "
FLIGHT_LENGTH = " y longitud total de líneas de producción "
FLIGHT_TOTAL = "Total de todas las longitudes: "
KML_HEADER = '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>Lineas</name>'
KML_FOOTER = "</Document></kml>"
KML_DIRECTION = "Dirección: "
KML_LENGTH = "Longitud: "


def _fixed_line(df: DataFrame, block: int, value: str) -> DataFrame:
    return df.sparkSession.range(1).select(
        F.lit(block).alias("block"), F.lit(0).cast("long").alias("ord"), F.lit(value).alias("value")
    )


def volume_text(chords: DataFrame) -> DataFrame:
    """Title, a line per chord, an empty line, the total."""
    rows = volume_report(chords)
    per_line = F.concat(
        F.lit(VOLUME_LINE), F.col("id").cast("string"), F.lit(": "), kilometres(F.col("long_km")),
        F.lit(" km"),
    )
    total = F.concat(
        F.lit(VOLUME_TOTAL), kilometres(F.coalesce("long_km", F.lit(0.0)))
    )
    body = rows.select(
        F.when(F.col("is_total"), 3).otherwise(1).alias("block"),
        F.coalesce(F.col("id").cast("long"), F.lit(0).cast("long")).alias("ord"),
        F.when(F.col("is_total"), total).otherwise(per_line).alias("value"),
    )
    return body.unionByName(_fixed_line(chords, 0, VOLUME_TITLE)).unionByName(
        _fixed_line(chords, 2, "")
    )


def area_text(areas: DataFrame, project: str = "project_id") -> DataFrame:
    """Two lines per project: the area under both labels. The first holds square metres, as the
    report always did; ``ring_areas`` also gives true square kilometres.
    """
    lines = F.array(
        F.struct(
            F.lit(0).cast("long").alias("ord"),
            F.concat(F.lit(AREA_KM2), kilometres(F.col("area_m2"))).alias("value"),
        ),
        F.struct(
            F.lit(1).cast("long").alias("ord"),
            F.concat(F.lit(AREA_HA), kilometres(F.col("area_ha"))).alias("value"),
        ),
    )
    return areas.select(F.col(project).alias("block"), F.inline(lines))


def flight_text(report: DataFrame) -> DataFrame:
    """A line per flight and the grand total, from ``flights.flight_report``."""
    per_flight = F.concat(
        F.lit(FLIGHT), file_stem(F.col("flight")), F.lit(FLIGHT_DIRECTION), F.col("direction"),
        F.lit(FLIGHT_LENGTH), kilometres(F.col("total_km")),
        F.lit(" km"),
    )
    total = F.concat(
        F.lit(FLIGHT_TOTAL),
        kilometres(F.coalesce("total_km", F.lit(0.0))),
        F.lit(" km"),
    )
    return report.select(
        F.col("is_total").cast("int").alias("block"),
        F.col("flight").alias("ord"),
        F.when(F.col("is_total"), total).otherwise(per_flight).alias("value"),
    )


def _element(name: str, body: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))


def kml_placemarks(chords: DataFrame, srid: int | str = GEOGRAPHIC) -> DataFrame:
    """One KML Placemark per line of ``id, direction, coords`` and any further columns.

    The description gives direction and length (in the source system), then ``column: value`` for
    every further column. Coordinates are longitude and latitude.
    """
    lines = chords if "long_km" in chords.columns else with_length_km(chords)
    further = [c for c in lines.columns if c not in ("id", "direction", "long_km", "coords")]
    description = F.concat_ws(
        "\n",
        F.concat(F.lit(KML_DIRECTION), "direction"),
        F.concat(F.lit(KML_LENGTH), kilometres(F.col("long_km")), F.lit(" km")),
        *[
            F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None")))
            for c in further
        ],
    )
    coordinates = g.coordinate_text(reproject_coords(F.col("coords"), srid, GEOGRAPHIC))
    return lines.select(
        "id",
        _element(
            "Placemark",
            F.concat(
                _element("name", F.concat(F.lit(VOLUME_LINE), F.col("id").cast("string"))),
                _element("description", xml_escaped(description)),
                _element("LineString", _element("coordinates", coordinates)),
            ),
        ).alias("value"),
    )


def lines_kml(chords: DataFrame, srid: int | str = GEOGRAPHIC) -> DataFrame:
    body = kml_placemarks(chords, srid).select(
        F.lit(1).alias("block"), F.col("id").cast("long").alias("ord"), "value"
    )
    return _fixed_line(chords, 0, KML_HEADER).unionByName(body).unionByName(
        _fixed_line(chords, 2, KML_FOOTER)
    )


def ring_kml(rings: DataFrame, project: str = "project_id") -> DataFrame:
    """Polygon Placemarks of closed rings ``(project, pos, x, y)`` in longitude and latitude.

    One row of text per vertex, so a ring of any length stays distributed.
    """
    first = rings.filter(F.col("pos") == 0)
    head = first.select(
        project,
        F.lit(0).alias("block"),
        F.lit(0).cast("long").alias("ord"),
        F.lit(
            "<Placemark><Polygon><outerBoundaryIs><LinearRing><coordinates>"
        ).alias("value"),
    )
    tail = first.select(
        project,
        F.lit(2).alias("block"),
        F.lit(0).cast("long").alias("ord"),
        F.lit(
            "</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"
        ).alias("value"),
    )
    body = rings.select(
        project,
        F.lit(1).alias("block"),
        F.col("pos").alias("ord"),
        F.concat(F.col("x").cast("string"), F.lit(","), F.col("y").cast("string")).alias("value"),
    )
    return head.unionByName(body).unionByName(tail)
