"""Line grouping and merging against plain loops over all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skytrace.operators import graph, lines

SCHEMA = "row_id long, direction string, vertex_no long, x double, y double"


def layer(spark, shapes):
    """shapes: {row_id: (direction, [(x, y), ...])}"""
    rows = [
        (i, d, k, float(x), float(y))
        for i, (d, vertices) in shapes.items()
        for k, (x, y) in enumerate(vertices)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def squared_distance(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    length = dx * dx + dy * dy
    t = 0 if length == 0 else min(1, max(0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / length))
    return (p[0] - a[0] - t * dx) ** 2 + (p[1] - a[1] - t * dy) ** 2


def near(p, shape, tolerance):
    return any(squared_distance(p, a, b) <= tolerance**2 for a, b in zip(shape, shape[1:]))


def edges_of(shapes, tolerance=10):
    return {
        (i, j)
        for i, (d, a) in shapes.items()
        for j, (e, b) in shapes.items()
        if i != j and d == e and (near(a[0], b, tolerance) or near(a[-1], b, tolerance))
    }


def visited_groups(nodes, edges):
    """Each unassigned line in order takes everything it reaches, whatever it held before."""
    out = {}
    for i, j in edges:
        out.setdefault(i, []).append(j)
    group = {}
    for i in sorted(nodes):
        if i in group:
            continue
        stack, reached = [i], {i}
        while stack:
            for j in out.get(stack.pop(), []):
                if j not in reached:
                    reached.add(j)
                    stack.append(j)
        for j in reached:
            group[j] = i
    return group


def weak_groups(nodes, edges):
    both = edges | {(j, i) for i, j in edges}
    found = {}
    for i in sorted(nodes):
        if i not in found:
            part = visited_groups([i], both)
            found.update({j: i for j in part})
    return found


def random_shapes(seed, n=150, spread=120, grain=1.0):
    rng = random.Random(seed)
    shapes = {}
    for i in range(n):
        x, y = rng.uniform(0, spread), rng.uniform(0, spread)
        angle = rng.choice([0, 0.1, math.pi / 2, 1.0])
        step = rng.choice([3, 15, 60])
        vertices = [
            (
                round((x + k * step * math.cos(angle)) / grain) * grain,
                round((y + k * step * math.sin(angle)) / grain) * grain,
            )
            for k in range(rng.randint(2, 5))
        ]
        shapes[i * 3] = (rng.choice(["N - S", "E - W"]), vertices)
    return shapes


def collected(df):
    return {r.row_id: r.grp for r in df.collect()}


@pytest.mark.parametrize("cell_points", [1, 32])
@pytest.mark.parametrize("seed,spread", [(1, 400), (2, 1500)])
def test_groups_match_the_visiting_rule(spark, monkeypatch, cell_points, seed, spread):
    monkeypatch.setattr(lines, "CELL_POINTS", cell_points)
    shapes = random_shapes(seed, spread=spread)
    got = collected(lines.proximity_groups(layer(spark, shapes)))
    assert got == visited_groups(shapes, edges_of(shapes))


def test_weak_groups_are_components(spark):
    shapes = random_shapes(5, spread=1200)
    got = collected(lines.proximity_groups(layer(spark, shapes), mode="weak"))
    assert got == weak_groups(shapes, edges_of(shapes))


def test_crowded_cell_links_are_exact(spark, monkeypatch):
    """Hundreds of distinct endpoints in one cell, segments around the tolerance limit."""
    monkeypatch.setattr(lines, "CELL_POINTS", 4)
    rng = random.Random(11)
    shapes = {}
    for i in range(300):
        start = (700 + rng.uniform(0, 7), 700 + rng.uniform(0, 7))
        shapes[i] = ("E - W", [start, (start[0] + 500 + 30 * i, start[1] + 40 * i)])
    for i in range(300, 360):
        r = rng.uniform(8, 18)
        turn = rng.uniform(0, 2 * math.pi)
        x, y = 703.5 + r * math.cos(turn), 703.5 + r * math.sin(turn)
        shapes[i] = ("E - W", [(x, y), (x + math.cos(turn), y + math.sin(turn))])
    df = layer(spark, shapes)
    got = {(r.cx, r.cy, r.row_id) for r in lines.cell_links(df).collect()}
    want = set()
    for d, v in shapes.values():
        for p in (v[0], v[-1]):
            cell = (math.floor(p[0] / 7), math.floor(p[1] / 7))
            want |= {(*cell, j) for j, (_, s) in shapes.items() if near(p, s, 10)}
    assert got == want


def test_long_segments_take_few_rows(spark):
    """A segment of a million tolerances, beside short ones all along it."""
    rng = random.Random(12)
    shapes = {0: ("E - W", [(-5e6, -1e6), (5e6, 2e6)])}
    for i in range(1, 150):
        x = rng.uniform(-5e6, 5e6)
        y = -1e6 + 3e6 * (x + 5e6) / 1e7 + rng.uniform(-16, 16)
        shapes[i] = ("E - W", [(x, y), (x + rng.choice([1, 40, 3000]), y + 60)])
    shapes[200] = ("E - W", [(-4e6, 1e6), (4e6, 1e6 + 5)])
    shapes[201] = ("E - W", [(0, 1e6 - 4), (0, 2e6)])
    df = layer(spark, shapes)
    pieces = lines._segment_pieces(df, 20.0).groupBy("row_id").count().collect()
    assert max(r["count"] for r in pieces) < 100
    got = {(r.cx, r.cy, r.row_id) for r in lines.cell_links(df).collect()}
    want = set()
    for d, a in shapes.values():
        for x, y in (a[0], a[-1]):
            cell = (math.floor(x / 7), math.floor(y / 7))
            want |= {(*cell, j) for j, (e, b) in shapes.items() if e == d and near((x, y), b, 10)}
    assert got == want
    assert len({r[2] for r in got if r[2] in (0, 200)}) == 2


def test_sums_do_not_depend_on_the_order(spark):
    from fractions import Fraction

    from skytrace.functions.exact import ExactSum

    rng = random.Random(3)
    groups = {
        0: [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-12, 13) for _ in range(3000)],
        1: [1e16, 1.0, -1e16, 3e-9],
        2: [-0.1] * 10,
        3: [1e-300, 5.0],
        4: [0.0],
        5: [float("inf"), 1.0],
        6: [None],
        7: [2.0**98, -(2.0**98), 2.0**-100],
    }
    rows = [(k, v) for k, own in groups.items() for v in own]
    total = ExactSum("v", F.col("v"))
    seen = []
    for parts in (1, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
        sums = df.groupBy("k").agg(*total.aggregates()).select("k", total.total().alias("s"))
        seen.append({r.k: r.s for r in sums.collect()})
    assert seen[0] == seen[1]
    for k, own in groups.items():
        if k in (5, 6):
            assert seen[0][k] == {5: float("inf"), 6: None}[k]
            continue
        exact = float(sum(map(Fraction, own)))
        assert seen[0][k] == pytest.approx(exact, rel=3e-16, abs=1e-30)


def test_layers_of_different_systems_are_refused(spark):
    from skytrace.functions.crs import marked, srid_of

    one = layer(spark, {1: ("E - W", [(0, 0), (50, 0)])})
    other = layer(spark, {2: ("E - W", [(55, 0), (90, 0)])})
    utm, mercator = marked(one, 32614, "x", "y"), marked(other, 3857, "x", "y")
    with pytest.raises(ValueError, match="reference system"):
        lines.merge_lines([utm, mercator])
    with pytest.raises(ValueError, match="reference system"):
        lines.layer_union([utm, other], srids=[None, 3857])
    both = one.withColumn("srid", F.lit(32614)).unionByName(other.withColumn("srid", F.lit(3857)))
    with pytest.raises(ValueError, match="reference system"):
        lines.merge_lines(both)
    assert srid_of(lines.layer_union([utm, other])) == 32614
    chords = lines.merge_lines([utm, marked(other, "EPSG:32614", "x", "y")])
    assert srid_of(chords) == 32614 and chords.count() == 1


def test_features_of_every_kind(spark):
    line, other = [(0.0, 0.0), (3.0, 4.0)], [(9.0, 9.0), (9.0, 8.0), (7.0, 8.0)]
    parts = {1: None, 2: [], 3: [line[:1]], 4: [line], 5: [line, other], 6: [line[:1], other], 7: [[], []]}
    rows = [(i, "E - W", p) for i, p in parts.items()] + [(8, "E - W", [line[:1], line[1:]])]
    kind = "row_id long, direction string, parts array<array<struct<x: double, y: double>>>"
    vertices, rejects = lines.feature_vertices(spark.createDataFrame(rows, kind))
    got = {(r.row_id, r.vertex_no): (r.x, r.next_x) for r in vertices.collect()}
    assert got == {
        (4, 0): (0, 3), (4, 1): (3, None),
        (5, 0): (0, 3), (5, 1): (3, None), (5, 2): (9, 9), (5, 3): (9, 7), (5, 4): (7, None),
        (6, 0): (9, 9), (6, 1): (9, 7), (6, 2): (7, None),
    }
    reasons = {r.row_id: r.reason for r in rejects.collect()}
    assert reasons == {1: "no_shape", 2: "no_shape", 3: "point", 7: "no_line", 8: "no_line"}


def test_later_seed_takes_over(spark):
    """2 -> 1 and 3 -> 1 without ways back: 1 ends up with 3, and 2 alone."""
    target = [(0, 0), (1000, 0)]
    shapes = {
        1: ("N - S", target),
        2: ("N - S", [(300, 8), (300, 200)]),
        3: ("N - S", [(600, 8), (600, 200)]),
    }
    assert edges_of(shapes) == {(2, 1), (3, 1)}
    got = collected(lines.proximity_groups(layer(spark, shapes)))
    assert got == {1: 3, 2: 2, 3: 3}


def test_tolerance_is_inclusive_and_directions_stay_apart(spark):
    shapes = {
        1: ("E - W", [(0, 0), (100, 0)]),
        2: ("E - W", [(110, 0), (200, 0)]),
        3: ("E - W", [(100, 10.000001), (100, 300)]),
        4: ("N - S", [(0, 0), (100, 0)]),
    }
    assert collected(lines.proximity_groups(layer(spark, shapes))) == {1: 1, 2: 1, 3: 3, 4: 4}


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(4)
    names = list(range(400))
    rng.shuffle(names)
    path = list(zip(names, names[1:]))
    star = [(1000, 1000 + k) for k in range(1, 300)]
    edges = spark.createDataFrame(path + star, "src long, dst long")
    got = {r.node: r.component for r in graph.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(400), 0), **{1000 + k: 1000 for k in range(300)}}


@pytest.mark.parametrize(
    "shape", ["path", "ring", "ring with a tail", "tree", "ladder", "wide ladder", "ladder ring"]
)
def test_long_ways_take_few_rounds(spark, monkeypatch, shape):
    n = 200
    order = list(range(n))
    random.Random(5).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)]
    if shape == "ring":
        edges.append((order[-1], order[0]))
    elif shape == "ring with a tail":
        edges.append((order[99], order[0]))
        edges.remove((order[99], order[100]))
        edges.append((order[50], order[100]))
    elif shape == "tree":
        edges = [(order[i // 2], order[i]) for i in range(1, n)]
    elif "ladder" in shape:  # every node but the first few has two predecessors or more
        ahead = (1, 2, 3, 5) if shape == "wide ladder" else (1, 2)
        last = n if shape == "ladder ring" else 0
        edges = [(order[i], order[(i + k) % n]) for i in range(n) for k in ahead if i + k < n + last]
    cuts = []
    monkeypatch.setattr(graph, "cut", lambda df, cut=graph.cut: cuts.append(1) or cut(df))
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.seed for r in graph.last_seed(df).collect()}
    following = {}
    for a, b in edges:
        following.setdefault(a, []).append(b)

    def reached(start):
        seen, todo = {start}, [start]
        while todo:
            for b in following.get(todo.pop(), []):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        return seen

    reach = {a: reached(a) for a in range(n)}
    seeds = [a for a in range(n) if not any(a in reach[b] for b in range(a))]
    assert got == {b: max(a for a in seeds if b in reach[a]) for b in range(n)}
    assert len(cuts) <= (2 * (3 * 10 + 8) if "ladder" in shape else 2 * (10 + 4))


@pytest.mark.parametrize("seed", [1, 2])
def test_last_seed_on_random_digraphs(spark, seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(60), rng.randrange(60)) for _ in range(55)}
    edges = {(a, b) for a, b in edges if a != b}
    nodes = {n for e in edges for n in e}
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    got = {r.node: r.seed for r in graph.last_seed(df).collect()}
    assert got == visited_groups(nodes, edges)


def test_next_vertex_across_chunks(spark):
    shapes = random_shapes(9, n=20)
    df = layer(spark, shapes)
    for chunk in (1, 2, 100):
        got = {
            (r.row_id, r.vertex_no): (r.next_x, r.next_y)
            for r in lines.segments(df, chunk_rows=chunk).collect()
        }
        assert got == {
            (i, k): v for i, (_, vs) in shapes.items() for k, v in enumerate(vs[1:])
        }


def test_shared_segments_count_once(spark):
    shapes = {
        1: ("E - W", [(0, 0), (50, 0)]),
        2: ("E - W", [(50, 0), (0, 0)]),
        3: ("E - W", [(50, 0), (90, 0)]),
    }
    df = layer(spark, shapes)
    (row,) = lines.merged_lines(df, lines.proximity_groups(df)).collect()
    assert row.long_km == pytest.approx(0.09) and row.cx == pytest.approx(45)
    assert (row.most.x, row.least.x) == (90, 0)


def test_merge_orders_blocks_and_straightens(spark):
    shapes = {
        1: ("Dirección desconocida", [(0, 900), (5, 905)]),
        2: ("E - W", [(0, 100), (80, 130), (50, 100)]),
        3: ("E - W", [(0, 300), (80, 300)]),
        4: ("N - S", [(700, 0), (700, 50)]),
        5: ("N - S", [(500, 0), (500, 50), (503, 50)]),
    }
    rows = lines.merge_lines(layer(spark, shapes)).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, 5]
    chords = [[(p.x, p.y) for p in r.coords] for r in rows]
    assert chords == [
        [(500, 50), (500, 0)],  # first of two vertices with the greatest y
        [(700, 50), (700, 0)],
        [(80, 300), (0, 300)],
        [(80, 130), (0, 100)],
        [(5, 905), (0, 900)],
    ]
    ends = lines.line_endpoints(spark.createDataFrame(rows)).orderBy("point_id").collect()
    assert [(e.point_id, e.line_id, e.type) for e in ends[:3]] == [
        (0, 0, "Min"),
        (1, 0, "Max"),
        (2, 1, "Min"),
    ]


def test_singletons_go_for_chosen_directions(spark):
    shapes = {
        1: ("E - W", [(0, 0), (50, 0)]),
        2: ("E - W", [(55, 0), (90, 0)]),
        3: ("E - W", [(0, 500), (50, 500)]),
        4: ("N - S", [(0, 0), (0, 50)]),
    }
    groups = lines.proximity_groups(layer(spark, shapes))
    assert set(collected(lines.drop_singletons(groups, ["E - W"]))) == {1, 2, 4}
    assert set(collected(lines.drop_singletons(groups))) == {1, 2}


def test_global_numbers_are_dense(spark):
    from skytrace.operators.sequence import number_globally

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(6)
    got = {r.k: r.n for r in number_globally(df, ["k"], "n").collect()}
    assert got == {k: k + 1 for k in range(1000)}


def test_no_nested_loops(spark):
    shapes = random_shapes(1, n=30)
    plan = lines.cell_links(layer(spark, shapes))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_merging_reads_its_layer_once(spark):
    """Grouping, dissolving and the extremes share one written copy of the layer."""
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    rows = [
        (i, "E - W", k, 100.0 * k, 50.0 * (i // 2) + i % 2) for i in range(8) for k in range(3)
    ]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted), SCHEMA)
    chords = lines.merge_lines(df).collect()
    assert len(chords) == 4
    assert read.value == len(rows)


@pytest.mark.parametrize("size", [1.0, 1000.0])
def test_short_segments_and_ends_meet_in_few_squares(spark, size):
    rng = random.Random(13)
    at = lambda: rng.uniform(-3000 * size, 3000 * size)
    shapes = {}
    for i in range(400):
        x, y, turn = at(), at(), rng.uniform(0, 2 * math.pi)
        far = rng.choice([0, 8, 45, 300]) * size
        shapes[i] = ("E - W", [(x, y), (x + far * math.cos(turn), y + far * math.sin(turn))])
    for i in range(400):  # ends close to the limit
        (ax, ay), (bx, by) = shapes[i][1]
        t, turn = rng.random(), rng.uniform(0, 2 * math.pi)
        off = rng.uniform(9.9, 10.1) * size
        x, y = ax + t * (bx - ax) + off * math.cos(turn), ay + t * (by - ay) + off * math.sin(turn)
        shapes[400 + i] = ("E - W", [(x, y), (x + size, y)])
    df = layer(spark, shapes)
    squares = lines._touched_squares(lines._with_level(df, 20.0 * size), 40.0 * size)
    # A box of a piece touches four squares at most; on average it is two or so.
    assert squares.count() < 2.6 * sum(
        max(1, math.ceil(math.dist(*v) / (40 * size))) for _, v in shapes.values()
    )
    got = {(r.cx, r.cy, r.row_id) for r in lines.cell_links(df, 10.0 * size).collect()}
    want = set()
    for _, v in shapes.values():
        for p in v:
            cell = (math.floor(p[0] / (0.7 * 10 * size)), math.floor(p[1] / (0.7 * 10 * size)))
            want |= {(*cell, j) for j, (_, s) in shapes.items() if near(p, s, 10 * size)}
    assert got == want
