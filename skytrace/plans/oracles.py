"""The registered queries in plain SQL, written independently of the operators.

They use whole-flight windows, all-pairs distances and recursion: right by inspection, and run by
DuckDB on small tables only.
"""

from __future__ import annotations

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}

CTES["track"] = """
events_u AS (
  SELECT user_id % 8 AS f, event_type, value - floor(value) AS u,
         row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) - 1 AS seq
  FROM events),
passes AS (SELECT *, seq // 56 AS k, seq % 56 AS j FROM events_u),
placed AS (
  SELECT *,
    CAST(CASE WHEN j < 50 THEN CASE WHEN k % 2 = 0 THEN j ELSE 49 - j END
              ELSE CASE WHEN k % 2 = 0 THEN 49 ELSE 0 END END AS DOUBLE) * 1e-4 AS along,
    (CAST(k AS DOUBLE) + CAST(CASE WHEN j < 50 THEN 0 ELSE j - 49 END AS DOUBLE) / 7) * 1e-3
      + u * 2e-6 AS across
  FROM passes),
track AS (
  SELECT CAST(f AS VARCHAR) AS flight, seq,
    CASE WHEN f % 2 = 0 THEN along ELSE across END - 99 AS x,
    CASE WHEN f % 2 = 0 THEN across ELSE along END + 19 AS y,
    CASE WHEN event_type = 'error' AND seq % 11 = 0 THEN -1.0 ELSE 2200 + u END AS z
  FROM placed)"""

CTES["clean"] = """
clean AS (
  SELECT flight, round_even(x * 1e9, 0) / 1e9 AS x, round_even(y * 1e6, 0) / 1e6 AS y, z,
         min(seq) AS seq
  FROM track WHERE z >= 0 GROUP BY 1, 2, 3, 4)"""

CTES["grouped"] = """
neighbours AS (
  SELECT *, lead(seq) OVER w AS next_seq, lead(x) OVER w AS nx, lead(y) OVER w AS ny,
         lag(x) OVER w AS px, lag(y) OVER w AS py
  FROM clean WINDOW w AS (PARTITION BY flight ORDER BY seq)),
steps AS (
  SELECT flight, seq, x, y,
         CASE WHEN next_seq IS NULL THEN x - px ELSE nx - x END AS dx,
         CASE WHEN next_seq IS NULL THEN y - py ELSE ny - y END AS dy
  FROM neighbours),
headed AS (
  SELECT flight, seq, x, y,
         CASE WHEN dx <> 0 OR dy <> 0 THEN ((degrees(atan2(dy, dx)) % 360) + 360) % 360 END AS deg
  FROM steps),
grouped AS (
  SELECT flight, seq, x, y,
         CASE WHEN deg <= 5 OR deg > 355 THEN 360
              WHEN deg IS NOT NULL THEN CAST(ceil((deg - 5) / 10) * 10 AS INTEGER) END AS grp
  FROM headed),
heading_counts AS (
  SELECT flight, grp, count(*) AS n, min(seq) AS first_seq
  FROM grouped WHERE grp IS NOT NULL GROUP BY 1, 2),
tops AS (
  SELECT flight, grp, n, first_seq,
         row_number() OVER (PARTITION BY flight ORDER BY n DESC, first_seq) AS rank
  FROM heading_counts QUALIFY rank <= 2)"""

CTES["lines_of_flights"] = """
marked AS (
  SELECT p.flight, p.seq, p.x, p.y, t.grp AS fil
  FROM grouped p LEFT JOIN tops t ON p.flight = t.flight AND p.grp = t.grp),
gaps AS (
  SELECT *, CASE WHEN fil IS NULL AND lag(fil) OVER (PARTITION BY flight ORDER BY seq) IS NOT NULL
                 THEN 1 ELSE 0 END AS gap
  FROM marked),
runs AS (
  SELECT *, CAST(1 + sum(gap) OVER (PARTITION BY flight ORDER BY seq) AS BIGINT) AS run
  FROM gaps),
in_runs AS (SELECT * FROM runs WHERE fil IS NOT NULL),
sizes AS (
  SELECT flight, run, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
  FROM in_runs GROUP BY 1, 2),
kept AS (
  SELECT * FROM sizes
  QUALIFY n >= max(n) OVER (PARTITION BY flight) - max(n) OVER (PARTITION BY flight) // 3
      AND n >= 2),
directions AS (
  SELECT i.flight,
         CASE WHEN bool_or(fil IN (180, 360)) THEN 'E - W'
              WHEN bool_or(fil IN (90, 270)) THEN 'N - S'
              ELSE 'Dirección desconocida' END AS direction
  FROM in_runs i JOIN kept k ON i.flight = k.flight AND i.run = k.run GROUP BY 1),
flight_lines AS (
  SELECT k.*, d.direction, row_number() OVER (PARTITION BY k.flight ORDER BY run) AS id
  FROM kept k JOIN directions d ON k.flight = d.flight),
vertices AS (
  SELECT i.flight, CAST(l.id AS INTEGER) AS id, l.direction, l.run, i.seq, i.x, i.y
  FROM in_runs i JOIN flight_lines l ON i.flight = l.flight AND i.run = l.run)"""


def utm_ctes(source: str, zone: int) -> str:
    """``projected``: the rows of ``source`` with x, y replaced by UTM coordinates."""
    # WGS 84 eccentricity, scale times rectifying radius, Krueger's series.
    e, scale = 0.08181919084262149, 6364902.166165086
    alpha = [
        0.0008377318206303529,
        7.608527714248998e-07,
        1.1976380015605232e-09,
        2.4433761945220637e-12,
    ]
    north = " + ".join(
        ["xi"] + [f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(alpha, 1)]
    )
    east = " + ".join(
        ["eta"] + [f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(alpha, 1)]
    )
    return f"""
radial AS (
  SELECT *, sin(radians(y)) AS s, radians(x) - radians({zone * 6 - 183}) AS dl FROM {source}),
conformal AS (SELECT *, sinh(atanh(s) - {e!r} * atanh({e!r} * s)) AS t FROM radial),
spherical AS (
  SELECT *, atan2(t, cos(dl)) AS xi, asinh(sin(dl) / sqrt(t * t + cos(dl) * cos(dl))) AS eta
  FROM conformal),
projected AS (
  SELECT * REPLACE (500000 + {scale!r} * ({east}) AS x, {scale!r} * ({north}) AS y)
  FROM spherical)"""


CTES["measured"] = """
stepped AS (
  SELECT *, lead(x) OVER w AS next_x, lead(y) OVER w AS next_y
  FROM projected WINDOW w AS (PARTITION BY flight, id ORDER BY seq)),
measured AS (
  SELECT flight, id, direction,
         sum(sqrt((next_x - x) * (next_x - x) + (next_y - y) * (next_y - y))) / 1000 AS long_km,
         count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq,
         arg_min(x, seq) AS start_x, arg_min(y, seq) AS start_y,
         arg_max(x, seq) AS end_x, arg_max(y, seq) AS end_y
  FROM stepped GROUP BY 1, 2, 3)"""

CTES["line_layer"] = """
seeds AS (
  SELECT p_partkey AS id, p_partkey // 4 AS r, p_partkey % 4 AS sg,
         CASE WHEN p_size % 2 = 0 THEN 0 ELSE 10 END AS gap
  FROM part),
ab AS (
  SELECT id, r, v AS vertex_no,
    CAST(CASE WHEN r % 10 = 3 AND sg >= 2 THEN 20 + 15 * sg
              ELSE 100 * sg + CASE v WHEN 0 THEN gap WHEN 1 THEN 48 ELSE 96 END END AS DOUBLE) AS a,
    CAST(CASE WHEN r % 10 = 3 AND sg >= 2 THEN 50 * r + 5 + 10 * v
              ELSE 50 * r + CASE v WHEN 1 THEN 1 ELSE 0 END END AS DOUBLE) AS b
  FROM seeds, (SELECT unnest([0, 1, 2]) AS v)),
line_vertices AS (
  SELECT id AS row_id, CASE WHEN r % 2 = 0 THEN 'E - W' ELSE 'N - S' END AS direction,
         CAST(vertex_no AS BIGINT) AS vertex_no,
         CASE WHEN r % 2 = 0 THEN a ELSE b END AS x, CASE WHEN r % 2 = 0 THEN b ELSE a END AS y
  FROM ab)"""

CTES["grouping_input_layer"] = """
grouping_input AS (SELECT row_id, direction, vertex_no, x, y FROM line_vertices)"""

CTES["grouping_input_flights"] = """
grouping_input AS (
  SELECT dense_rank() OVER (ORDER BY flight, id) AS row_id, direction, seq AS vertex_no, x, y
  FROM projected)"""

CTES["edges"] = """
segs AS (
  SELECT * FROM (
    SELECT row_id, direction, vertex_no, x AS x1, y AS y1,
           lead(x) OVER w AS x2, lead(y) OVER w AS y2
    FROM grouping_input WINDOW w AS (PARTITION BY row_id ORDER BY vertex_no)) s
  WHERE x2 IS NOT NULL),
ends AS (
  SELECT row_id, direction, arg_min(x, vertex_no) AS x, arg_min(y, vertex_no) AS y
  FROM grouping_input GROUP BY 1, 2
  UNION ALL
  SELECT row_id, direction, arg_max(x, vertex_no), arg_max(y, vertex_no)
  FROM grouping_input GROUP BY 1, 2),
pairs AS (
  SELECT e.direction, e.row_id AS src, e.x, e.y, s.row_id AS dst,
         x1, y1, x2 - x1 AS dx, y2 - y1 AS dy,
         CASE WHEN x1 = x2 AND y1 = y2 THEN 0 ELSE
           least(1, greatest(0, ((e.x - x1) * (x2 - x1) + (e.y - y1) * (y2 - y1))
             / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) END AS t
  FROM ends e JOIN segs s ON e.direction = s.direction),
near AS (
  SELECT direction, src, x, y, dst FROM pairs
  WHERE (x - (x1 + t * dx)) * (x - (x1 + t * dx)) + (y - (y1 + t * dy)) * (y - (y1 + t * dy))
        <= 100),
edges AS (SELECT DISTINCT src, dst FROM near WHERE src <> dst),
layer_rows AS (SELECT DISTINCT row_id, direction FROM grouping_input)"""

CTES["groups"] = """
reach AS (
  SELECT row_id AS node, row_id AS root FROM layer_rows
  UNION
  SELECT e.dst, r.root FROM reach r JOIN edges e ON e.src = r.node),
seed_rows AS (SELECT node FROM reach GROUP BY node HAVING min(root) = node),
groups AS (
  SELECT l.row_id, l.direction, max(r.root) AS grp
  FROM layer_rows l JOIN reach r ON l.row_id = r.node
  WHERE r.root IN (SELECT node FROM seed_rows) GROUP BY 1, 2)"""

CTES["weak_groups"] = """
both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reach AS (
  SELECT row_id AS node, row_id AS root FROM layer_rows
  UNION
  SELECT e.dst, r.root FROM reach r JOIN both_ways e ON e.src = r.node),
groups AS (
  SELECT l.row_id, l.direction, min(r.root) AS grp
  FROM layer_rows l JOIN reach r ON l.row_id = r.node GROUP BY 1, 2)"""

CTES["all_kept"] = """
kept_groups AS (SELECT * FROM groups)"""


def _without_singles(direction: str) -> str:
    return f"""
kept_groups AS (
  SELECT * FROM groups
  QUALIFY NOT (direction = '{direction}' AND count(*) OVER (PARTITION BY direction, grp) = 1))"""


CTES["without_single_ew"] = _without_singles("E - W")
CTES["without_single_ns"] = _without_singles("N - S")

CTES["merged"] = """
undirected AS (
  SELECT DISTINCT g.direction, g.grp,
    CASE WHEN (x1, y1) <= (x2, y2) THEN x1 ELSE x2 END AS ax,
    CASE WHEN (x1, y1) <= (x2, y2) THEN y1 ELSE y2 END AS ay,
    CASE WHEN (x1, y1) <= (x2, y2) THEN x2 ELSE x1 END AS bx,
    CASE WHEN (x1, y1) <= (x2, y2) THEN y2 ELSE y1 END AS by_
  FROM segs s JOIN kept_groups g ON s.row_id = g.row_id),
weighed AS (
  SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS w FROM undirected),
centred AS (
  SELECT direction, grp, w / power(2, 60) / 1000 AS long_km, wx / w AS cx, wy / w AS cy
  FROM (
    SELECT direction, grp, CAST(sum(CAST(w * power(2, 60) AS HUGEINT)) AS DOUBLE) AS w,
           CAST(sum(CAST(w * (ax + bx) / 2 * power(2, 60) AS HUGEINT)) AS DOUBLE) AS wx,
           CAST(sum(CAST(w * (ay + by_) / 2 * power(2, 60) AS HUGEINT)) AS DOUBLE) AS wy
    FROM weighed GROUP BY 1, 2)),
members AS (
  SELECT g.direction, g.grp, v.row_id, v.vertex_no, v.x, v.y,
         CASE WHEN g.direction = 'E - W' THEN v.x ELSE v.y END AS along
  FROM grouping_input v JOIN kept_groups g ON v.row_id = g.row_id),
extremes AS (
  SELECT direction, grp,
         first(x ORDER BY along DESC, row_id, vertex_no) AS most_x,
         first(y ORDER BY along DESC, row_id, vertex_no) AS most_y,
         first(x ORDER BY along, row_id, vertex_no) AS least_x,
         first(y ORDER BY along, row_id, vertex_no) AS least_y
  FROM members GROUP BY 1, 2),
merged AS (
  SELECT c.*, e.most_x, e.most_y, e.least_x, e.least_y,
    row_number() OVER (ORDER BY
      CASE c.direction WHEN 'N - S' THEN 0 WHEN 'E - W' THEN 1 ELSE 2 END,
      CASE c.direction WHEN 'N - S' THEN cx WHEN 'E - W' THEN -cy ELSE cy END, c.grp
      ) AS id
  FROM centred c JOIN extremes e ON c.direction = e.direction AND c.grp = e.grp)"""

CTES["layer_lists"] = """
layer_lines AS (
  SELECT row_id AS id, direction, list(x ORDER BY vertex_no) AS xs, list(y ORDER BY vertex_no) AS ys
  FROM line_vertices GROUP BY 1, 2),
layer_measures AS (
  SELECT *, sqrt((xs[2] - xs[1]) * (xs[2] - xs[1]) + (ys[2] - ys[1]) * (ys[2] - ys[1])) AS w1,
         sqrt((xs[3] - xs[2]) * (xs[3] - xs[2]) + (ys[3] - ys[2]) * (ys[3] - ys[2])) AS w2,
         'LINESTRING (' || xs[1] || ' ' || ys[1] || ', ' || xs[2] || ' ' || ys[2] || ', '
           || xs[3] || ' ' || ys[3] || ')' AS wkt
  FROM layer_lines)"""

CTES["endpoints"] = """
endpoints AS (
  SELECT (id - 1) * 2 AS point_id, id - 1 AS line_id, 'Min' AS type, xs[1] AS x, ys[1] AS y
  FROM layer_lines
  UNION ALL
  SELECT (id - 1) * 2 + 1, id - 1, 'Max', xs[3], ys[3] FROM layer_lines)"""

CTES["inside"] = """
corners AS (
  SELECT n_nationkey AS poly_id, [0, 150, 150, 60, 60, 0, 0] AS cx,
         [0, 0, 60, 60, 150, 150, 0] AS cy, 200 * (n_nationkey % 5) AS ox,
         200 * (n_nationkey // 5) AS oy
  FROM nation),
poly_edges AS (
  SELECT poly_id, CAST(ox + cx[i] AS DOUBLE) AS x1, CAST(oy + cy[i] AS DOUBLE) AS y1,
         CAST(ox + cx[i + 1] AS DOUBLE) AS x2, CAST(oy + cy[i + 1] AS DOUBLE) AS y2
  FROM corners, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i)),
cloud AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         l_partkey % 1000 + CAST(0.5 AS DOUBLE) AS x,
         l_suppkey * 10 + l_linenumber + CAST(0.5 AS DOUBLE) AS y, l_quantity AS z
  FROM lineitem),
places AS (SELECT DISTINCT x, y FROM cloud),
inside AS (
  SELECT DISTINCT x, y FROM (
    SELECT p.x, p.y, e.poly_id FROM places p, poly_edges e
    WHERE (e.y1 > p.y) <> (e.y2 > p.y)
      AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
    GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1) t)"""

CTES["rings"] = """
ring_points AS (
  SELECT (c_custkey - 1) // 30 AS project_id, (c_custkey - 1) % 30 AS pos,
         CAST(((c_custkey - 1) * 7 + c_nationkey) % 25 AS DOUBLE) AS x,
         CAST(((c_custkey - 1) * 11 + c_nationkey * 3) % 13 AS DOUBLE) AS y
  FROM customer),
ring AS (
  SELECT * FROM ring_points
  UNION ALL
  SELECT project_id, 30, x, y FROM ring_points WHERE pos = 0)"""

CTES["areas"] = """
ring_steps AS (
  SELECT project_id, x * lead(y) OVER w - lead(x) OVER w * y AS cross_ FROM ring
  WINDOW w AS (PARTITION BY project_id ORDER BY pos)),
ring_sums AS (SELECT project_id, abs(sum(cross_)) / 2 AS area FROM ring_steps GROUP BY 1),
places AS (SELECT project_id, count(DISTINCT (x, y)) AS n FROM ring GROUP BY 1),
areas AS (
  SELECT project_id, CASE WHEN n >= 3 THEN area END AS area_m2
  FROM ring_sums JOIN places USING (project_id))"""

CTES["photos"] = """
photo_log AS (
  SELECT CAST(o_custkey % 5 AS VARCHAR) AS file,
         row_number() OVER (PARTITION BY o_custkey % 5 ORDER BY o_orderkey) AS line_no,
         CASE WHEN o_orderkey % 13 = 0 THEN 'IMG'
              ELSE 'IMG' || o_orderkey || ' ' || o_orderpriority END AS value
  FROM orders)"""


def sql(ctes: list[str], select: str, recursive: bool = False) -> str:
    bodies = [CTES.get(name, name) for name in ctes]
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(bodies)}\n{select.strip()}"


PRODUCTION = ["track", "clean", "grouped", "lines_of_flights"]
UNPROJECTED = "\nprojected AS (SELECT * FROM vertices)"
PROJECTED = utm_ctes("vertices", 14)
LAYER = ["line_layer", "grouping_input_layer", "edges"]

ORACLES["track_points"] = sql(["track", "clean"], "SELECT flight, seq, x, y, z FROM clean")

ORACLES["route_points"] = sql(
    ["track"],
    f"""SELECT flight, seq, x, y, z, round(6378137.0 * radians(x), 4) AS east,
       round(6378137.0 * asinh(tan(radians(y))), 4) AS north, 3857 AS srid FROM track""",
)

ORACLES["bearing_groups"] = sql(
    ["track", "clean", "grouped"], "SELECT flight, grp, n, first_seq FROM heading_counts"
)

ORACLES["top_heading_groups"] = sql(
    ["track", "clean", "grouped"], "SELECT flight, grp, n, first_seq, rank FROM tops"
)

ORACLES["production_runs"] = sql(
    PRODUCTION, "SELECT flight, run, id, direction, n, first_seq, last_seq FROM flight_lines"
)

ORACLES["production_lines"] = sql(
    [*PRODUCTION, UNPROJECTED, "measured"],
    "SELECT * REPLACE (round(long_km, 12) AS long_km) FROM measured",
)

ORACLES["projected_lines"] = sql(
    [*PRODUCTION, PROJECTED, "measured"],
    """SELECT flight, id, direction, round(long_km, 7) AS long_km, round(start_x, 4) AS start_x,
       round(start_y, 4) AS start_y, round(end_x, 4) AS end_x, round(end_y, 4) AS end_y
       FROM measured""",
)

ORACLES["production_vertices"] = sql(
    [*PRODUCTION, UNPROJECTED, "measured"],
    "SELECT flight, id, direction, seq, x, y, next_x, next_y FROM stepped",
)

ORACLES["flight_report"] = sql(
    [*PRODUCTION, PROJECTED, "measured"],
    """SELECT flight, round(sum(long_km), 6) AS total_km,
       CASE WHEN grouping(flight) = 0 THEN max(direction) END AS direction,
       grouping(flight) = 1 AS is_total FROM measured GROUP BY ROLLUP (flight)""",
)

ORACLES["dominant_direction"] = sql(
    PRODUCTION,
    """, labelled AS (
      SELECT flight, seq, x, y, fil, run,
             CASE WHEN fil IN (90, 270) THEN 'N-S' WHEN fil IN (180, 360) THEN 'E-W' END AS label
      FROM in_runs),
    winners AS (
      SELECT flight, label FROM labelled WHERE label IS NOT NULL GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY flight ORDER BY count(*) DESC, min(seq)) = 1)
    SELECT l.* FROM labelled l JOIN winners w ON l.flight = w.flight AND l.label = w.label""",
)

ORACLES["rejected_flights"] = sql(
    PRODUCTION,
    """SELECT t.flight, CASE WHEN s.largest = 1 THEN 'single_point_run'
         ELSE 'no_production_run' END AS reason
    FROM (SELECT DISTINCT flight FROM track) t
    LEFT JOIN (SELECT flight, max(n) AS largest FROM sizes GROUP BY 1) s ON t.flight = s.flight
    WHERE coalesce(s.largest, 0) < 2""",
).replace(
    "user_id % 8",
    "CASE WHEN event_id % 500 <= (event_id // 500) % 3 THEN 1000000 + event_id // 500"
    " ELSE user_id % 8 END",
)

ORACLES["utm_inverse"] = sql(
    ["track", "clean"], "SELECT flight, seq, round(x, 8) AS lon, round(y, 8) AS lat FROM clean"
)

ORACLES["cell_links"] = sql(
    LAYER,
    """SELECT DISTINCT direction, CAST(floor(x / 7) AS BIGINT) AS cx,
       CAST(floor(y / 7) AS BIGINT) AS cy, dst AS row_id FROM near""",
)

ORACLES["proximity_groups"] = sql(
    [*LAYER, "groups"], "SELECT row_id, direction, grp FROM groups", recursive=True
)

ORACLES["proximity_groups_weak"] = sql(
    [*LAYER, "weak_groups"], "SELECT row_id, direction, grp FROM groups", recursive=True
)

ORACLES["drop_singletons"] = sql(
    [*LAYER, "groups", "without_single_ew"],
    "SELECT row_id, direction, grp FROM kept_groups",
    recursive=True,
)

ORACLES["dissolved_segments"] = sql(
    [*LAYER, "groups", "all_kept", "merged"],
    'SELECT direction, grp, ax, ay, bx, by_ AS "by" FROM undirected',
    recursive=True,
)

CTES["overlapping"] = """
placed AS (
  SELECT p_partkey % 40 AS c, (p_partkey * 7) % 97 + 150 * (p_partkey // 1500) AS start,
         3 + p_partkey % 11 AS len
  FROM part),
steps AS (
  SELECT c, start + len * i AS t1, start + len * (i + 1) AS t2
  FROM placed, (SELECT unnest([0, 1]) AS i)),
starts AS (SELECT c, t1, max(t2) AS t2 FROM steps GROUP BY 1, 2),
marked AS (
  SELECT *, CASE WHEN t1 < max(t2) OVER (PARTITION BY c ORDER BY t1
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
  FROM starts),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY c ORDER BY t1) AS piece FROM marked),
covered AS (SELECT c, piece, min(t1) AS t1, max(t2) AS t2 FROM numbered GROUP BY 1, 2),
ends AS (
  SELECT c, piece, CAST(t AS DOUBLE) AS t,
         CAST(CASE c % 4 WHEN 0 THEN t WHEN 1 THEN 1000 * c WHEN 2 THEN 2 * t ELSE -t END AS DOUBLE) AS x,
         CAST(CASE c % 4 WHEN 0 THEN 1000 * c WHEN 1 THEN t WHEN 2 THEN t + 1000 * c
              ELSE 3 * t + 1000 * c END AS DOUBLE) AS y
  FROM (SELECT c, piece, unnest([t1, t2]) AS t FROM covered)),
covered_segments AS (
  SELECT CASE WHEN c % 2 = 0 THEN 'E - W' ELSE 'N - S' END AS direction, c % 10 AS grp, c, piece,
         min(struct_pack(x, y)) AS a, max(struct_pack(x, y)) AS b
  FROM ends GROUP BY c, piece)"""

ORACLES["overlapping_segments"] = sql(
    ["overlapping"],
    """SELECT direction, grp, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by" FROM covered_segments""",
)

ORACLES["overlapping_lines"] = sql(
    ["overlapping"],
    """SELECT direction, grp, round(sum(w) / 1000, 9) AS long_km,
         round(sum(w * (a.x + b.x) / 2) / sum(w), 6) AS cx,
         round(sum(w * (a.y + b.y) / 2) / sum(w), 6) AS cy
       FROM (SELECT *, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS w
             FROM covered_segments)
       GROUP BY 1, 2""",
)

ORACLES["direction_order"] = sql(
    ["line_layer"],
    """SELECT direction, min(row_id) AS first_row,
              row_number() OVER (ORDER BY min(row_id)) AS rank
       FROM line_vertices GROUP BY direction""",
)

ORACLES["merged_lines"] = sql(
    [*LAYER, "groups", "all_kept", "merged"],
    """SELECT id, direction, grp, round(long_km, 9) AS long_km, round(cx, 6) AS cx,
       round(cy, 6) AS cy, most_x, most_y, least_x, least_y FROM merged""",
    recursive=True,
)

ORACLES["extreme_points"] = sql(
    [*LAYER, "groups", "all_kept", "merged"],
    """SELECT id, CASE direction WHEN 'E - W' THEN 'max_x' ELSE 'max_y' END AS kind,
              most_x AS x, most_y AS y FROM merged
       UNION ALL
       SELECT id, CASE direction WHEN 'E - W' THEN 'min_x' ELSE 'min_y' END, least_x, least_y
       FROM merged""",
    recursive=True,
)

ORACLES["extreme_chords"] = sql(
    [*LAYER, "groups", "without_single_ns", "merged"],
    """SELECT id, direction,
         'LINESTRING (' || most_x || ' ' || most_y || ', ' || least_x || ' ' || least_y || ')' AS wkt,
         round(sqrt((least_x - most_x) * (least_x - most_x)
                    + (least_y - most_y) * (least_y - most_y)) / 1000, 9) AS long_km
       FROM merged""",
    recursive=True,
)

ORACLES["survey_volume"] = sql(
    [*PRODUCTION, PROJECTED, "grouping_input_flights", "edges", "groups", "all_kept", "merged"],
    """SELECT id, direction,
         round(sqrt((least_x - most_x) * (least_x - most_x)
                    + (least_y - most_y) * (least_y - most_y)) / 1000, 6) AS long_km
       FROM merged""",
    recursive=True,
)

ORACLES["line_geometry"] = sql(
    ["line_layer", "layer_lists"],
    """SELECT id, round((w1 + w2) / 1000, 9) AS long_km,
         round((w1 * (xs[1] + xs[2]) / 2 + w2 * (xs[2] + xs[3]) / 2) / (w1 + w2), 6) AS cx,
         round((w1 * (ys[1] + ys[2]) / 2 + w2 * (ys[2] + ys[3]) / 2) / (w1 + w2), 6) AS cy,
         xs[1] AS start_x, ys[3] AS end_y, wkt
       FROM layer_measures""",
)

ORACLES["line_endpoints"] = sql(
    ["line_layer", "layer_lists", "endpoints"],
    "SELECT point_id, line_id, type, x, y FROM endpoints",
)

ORACLES["exclude_boxes"] = sql(
    ["line_layer", "layer_lists", "endpoints"],
    """SELECT point_id, line_id, type, x, y FROM endpoints e WHERE NOT EXISTS (
         SELECT 1 FROM region WHERE e.x BETWEEN 100 * r_regionkey AND 100 * r_regionkey + 120
           AND e.y BETWEEN 400 * r_regionkey AND 400 * r_regionkey + 350)""",
)

ORACLES["box_filter"] = sql(
    ["line_layer", "layer_lists", "endpoints"],
    """SELECT point_id, line_id, type, x, y FROM endpoints e WHERE EXISTS (
         SELECT 1 FROM region WHERE e.x BETWEEN 100 * r_regionkey AND 100 * r_regionkey + 120
           AND e.y BETWEEN 400 * r_regionkey AND 400 * r_regionkey + 350)""",
)

ORACLES["volume_report"] = sql(
    ["line_layer", "layer_lists"],
    """SELECT id, round(sum((w1 + w2) / 1000), 6) AS long_km, grouping(id) = 1 AS is_total
       FROM layer_measures GROUP BY ROLLUP (id)""",
)

ORACLES["kml_placemarks"] = sql(
    ["line_layer", "layer_lists"],
    """SELECT id, '<Placemark><name>Linea ' || id || '</name><description>Dirección: ' || direction
         || chr(10) || 'Longitud: ' || printf('%.3f', (w1 + w2) / 1000) || ' km</description>'
         || '<LineString><coordinates>' || xs[1] || ',' || ys[1] || ' ' || xs[2] || ',' || ys[2]
         || ' ' || xs[3] || ',' || ys[3] || '</coordinates></LineString></Placemark>' AS value
       FROM layer_measures""",
)

ORACLES["layer_union"] = """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance
FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"""

ORACLES["reprojected_union"] = sql(
    [*PRODUCTION, PROJECTED],
    """SELECT CAST(layer AS INTEGER) AS layer, flight, id, seq, round(x, 3) AS east,
              round(y, 3) AS north, 32614 AS srid
       FROM projected, (SELECT unnest([0, 1]) AS layer)""",
)

ORACLES["polygon_wkt"] = """
SELECT n_nationkey AS poly_id, 'POLYGON ((' || string_agg(
         CAST(200 * (n_nationkey % 5) + cx[i] AS DOUBLE) || ' '
           || CAST(200 * (n_nationkey // 5) + cy[i] AS DOUBLE), ', ' ORDER BY i) || '))' AS wkt
FROM nation, (SELECT unnest(range(1, 8)) AS i, [0, 150, 150, 60, 60, 0, 0] AS cx,
                     [0, 0, 60, 60, 150, 150, 0] AS cy)
GROUP BY n_nationkey"""

ORACLES["own_polygon"] = """
SELECT s_suppkey AS id, s_nationkey AS poly_id,
       s_suppkey % 151 < 60 AND s_suppkey * 7 % 151 < 150
       OR s_suppkey % 151 < 150 AND s_suppkey * 7 % 151 < 60 AS inside
FROM supplier"""

ORACLES["named_files"] = """
SELECT p_partkey AS id, '/survey/GNSS_' || p_partkey % 7 || '/GNSS_' || p_partkey || '.txt' AS path
FROM part WHERE p_partkey % 12 = 0"""

ORACLES["missing_inputs"] = "SELECT r_name, r_regionkey FROM region WHERE r_regionkey % 2 = 1"

ORACLES["mixed_shapes"] = """
SELECT p_partkey AS row_id,
       CASE p_partkey % 6 WHEN 2 THEN 2 WHEN 3 THEN 5 WHEN 4 THEN 3 END AS vertices,
       CAST(CASE p_partkey % 6 WHEN 2 THEN 5 WHEN 3 THEN 20 WHEN 4 THEN 15 END AS DOUBLE) AS length,
       CASE p_partkey % 6 WHEN 0 THEN 'no_shape' WHEN 1 THEN 'point' WHEN 5 THEN 'no_line' END AS reason,
       CASE WHEN p_partkey % 6 IN (2, 3, 4) THEN 32614 END AS srid
FROM part"""

ORACLES["ring_areas"] = sql(
    ["rings", "areas"],
    "SELECT *, area_m2 / 10000 AS area_ha, area_m2 / 1e6 AS area_km2 FROM areas",
)

ORACLES["polygon_area"] = sql(
    ["inside"],
    """SELECT CAST(poly_id AS BIGINT) AS poly_id, area AS area_m2, area / 10000 AS area_ha,
         area / 1e6 AS area_km2
       FROM (SELECT poly_id, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM poly_edges GROUP BY 1) t""",
)

ORACLES["crop_points"] = sql(
    ["inside"],
    """SELECT c.* FROM cloud c WHERE EXISTS (
         SELECT 1 FROM inside i WHERE i.x = c.x AND i.y = c.y)""",
)

CTES["renamed"] = """
renamed AS (
  SELECT file, line_no - 6 AS photo_no,
         CASE WHEN length(value) >= 8
              THEN 'DSC' || printf('%05d', line_no - 6) || '.JPG' || substr(value, 9)
              ELSE value END AS value
  FROM photo_log WHERE line_no > 6)"""

ORACLES["renumber_photos"] = sql(["photos", "renamed"], "SELECT * FROM renamed")

ORACLES["track_text"] = sql(["track"], "SELECT flight, seq, x, y, z FROM track")

ORACLES["track_skip_rows"] = sql(["track"], "SELECT flight, x, y, z FROM track")

ORACLES["track_rejects"] = """
SELECT DISTINCT CAST(o_orderkey % 3 AS VARCHAR) AS layout,
       CASE o_orderkey % 3 WHEN 1 THEN 'too_few_columns' ELSE 'row_longer_than_first' END AS reason
FROM orders WHERE o_orderkey % 3 <> 0"""

ORACLES["camera_log_text"] = ORACLES["renumber_photos"]

ORACLES["renamed_camera_logs"] = sql(
    ["photos", "renamed"],
    """SELECT 'Camara_v' || file || '__.txt' AS output, photo_no, value FROM renamed""",
)

ORACLES["flight_layers"] = sql(
    [*PRODUCTION, UNPROJECTED, "measured"],
    "SELECT 'Vuelo ' || flight || '_lineas.shp' AS flight, id, direction, n FROM measured",
)

ORACLES["point_layers"] = sql(
    ["track", "clean"],
    "SELECT 'Vuelo ' || flight || '_filtrada.shp' AS flight, seq, x, y, z FROM clean",
)

ORACLES["endpoint_layer"] = sql(
    ["line_layer", "layer_lists", "endpoints"],
    "SELECT point_id, line_id, type, x, y, 32614 AS srid FROM endpoints",
)

ORACLES["merged_layer"] = ORACLES["extreme_chords"]


def _numbered(ctes: list[str], rows: str) -> str:
    """The lines of a report, given as ``block, ord, value``, numbered from 1 on."""
    return sql(
        [*ctes, f"\nreport AS ({rows})"],
        "SELECT row_number() OVER (ORDER BY block, ord) AS line_no, value FROM report",
    )


ORACLES["volume_text"] = _numbered(
    ["line_layer", "layer_lists"],
    """SELECT 0 AS block, 0 AS ord, 'Volumen de Obra:' AS value
       UNION ALL
       SELECT 1, id, 'Linea ' || id || ': ' || printf('%.3f', (w1 + w2) / 1000) || ' km'
       FROM layer_measures
       UNION ALL SELECT 2, 0, ''
       UNION ALL
       SELECT 3, 0, 'Total de Longitud en km: ' || printf('%.3f', sum((w1 + w2) / 1000))
       FROM layer_measures""",
)

ORACLES["area_text"] = _numbered(
    ["rings", "areas"],
    """SELECT project_id AS block, 0 AS ord, 'Área en km²: ' || printf('%.3f', area_m2) AS value
       FROM areas
       UNION ALL
       SELECT project_id, 1, 'Área en hectáreas: ' || printf('%.3f', area_m2 / 10000) FROM areas""",
)

ORACLES["rings_kml"] = """
WITH """ + CTES["rings"] + """,
report AS (
  SELECT project_id, 0 AS block, 0 AS ord,
         '<Placemark><Polygon><outerBoundaryIs><LinearRing><coordinates>' AS value
  FROM ring WHERE pos = 0
  UNION ALL SELECT project_id, 1, pos, x || ',' || y FROM ring
  UNION ALL
  SELECT project_id, 2, 0, '</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>'
  FROM ring WHERE pos = 0)
SELECT row_number() OVER (ORDER BY project_id, block, ord) AS line_no, value FROM report"""

# A description has two lines, so a placemark takes two.
ORACLES["lines_kml"] = """
WITH marks AS (""" + ORACLES["kml_placemarks"] + """),
report AS (
  SELECT 0 AS block, 0 AS ord, 1 AS part,
         '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>Lineas</name>' AS value
  UNION ALL
  SELECT 1, id, part, string_split(value, chr(10))[part]
  FROM marks, (SELECT unnest([1, 2]) AS part)
  UNION ALL SELECT 2, 0, 1, '</Document></kml>')
SELECT row_number() OVER (ORDER BY block, ord, part) AS line_no, value FROM report"""

ORACLES["appended_flight_reports"] = sql(
    [*PRODUCTION, PROJECTED, "measured"],
    """, report AS (
      SELECT 0 AS block, flight, 'Vuelo: ' || flight || ' con dirección ' || max(direction)
        || ' y longitud total de líneas de producción ' || printf('%.3f', sum(long_km)) || ' km'
        AS value
      FROM measured GROUP BY flight
      UNION ALL
      SELECT 1, NULL, 'Total de todas las longitudes: ' || printf('%.3f', sum(long_km)) || ' km'
      FROM measured)
    SELECT CAST(run AS INTEGER) AS run,
           row_number() OVER (PARTITION BY run ORDER BY block, flight) AS line_no, value
    FROM report, (SELECT unnest([1, 2]) AS run)""",
)

ORACLES["reprojected_kml"] = sql(
    [*PRODUCTION, UNPROJECTED, "measured"],
    """SELECT flight || '/' || id AS id, round(start_x, 8) AS start_x, round(start_y, 8) AS start_y,
         round(end_x, 8) AS end_x, round(end_y, 8) AS end_y FROM measured""",
)

OBLIQUE = CTES["track"].replace(
    "CASE WHEN f % 2 = 0 THEN along ELSE across END - 99 AS x",
    "CASE WHEN f % 4 = 3 THEN along + across WHEN f % 2 = 0 THEN along ELSE across END - 99 AS x",
).replace(
    "CASE WHEN f % 2 = 0 THEN across ELSE along END + 19 AS y",
    "CASE WHEN f % 4 = 3 THEN along - across WHEN f % 2 = 0 THEN across ELSE along END + 19 AS y",
)

ORACLES["oblique_lines"] = sql(
    [OBLIQUE, *PRODUCTION[1:], UNPROJECTED, "measured"],
    "SELECT flight, id, direction, n, first_seq, last_seq FROM measured",
)

ORACLES["oblique_volume"] = ORACLES["survey_volume"].replace(CTES["track"], OBLIQUE)

ORACLES["las_cloud"] = sql(
    ["inside", """
records AS (
  SELECT l_linenumber AS ln, l_orderkey AS o, l_partkey AS p, l_suppkey AS s, x, y,
         CAST(z AS DOUBLE) AS z
  FROM cloud c WHERE EXISTS (SELECT 1 FROM inside i WHERE i.x = c.x AND i.y = c.y))"""],
    """SELECT x, y, z, CAST(o % 65536 AS INTEGER) AS intensity,
         CAST(ln % 16 AS INTEGER) AS return_number, 15 AS number_of_returns,
         CAST(s % 256 AS INTEGER) AS classification, CAST(ln % 16 AS INTEGER) AS class_flags,
         CAST(o % 4 AS INTEGER) AS scanner_channel, CAST(o % 2 AS INTEGER) AS scan_direction,
         CAST(p % 2 AS INTEGER) AS edge_of_line,
         round(CAST(p % 1000 - 500 AS DOUBLE) * CAST(0.006 AS DOUBLE), 3) AS scan_angle,
         CAST(p % 256 AS INTEGER) AS user_data, CAST(s % 65536 AS INTEGER) AS point_source_id,
         CAST(o AS DOUBLE) * CAST(0.25 AS DOUBLE) AS gps_time, CAST(p % 65536 AS INTEGER) AS red,
         40000 AS green, 7 AS blue, CAST(o % 50000 AS INTEGER) AS nir
       FROM records""",
)

ORACLES["line_shapefile"] = sql(
    ["line_layer", "layer_lists"],
    """SELECT id, 'dirección ' || direction AS direction, round((w1 + w2) / 1000, 9) AS long_km,
         32614 AS srid, wkt
       FROM layer_measures""",
)
