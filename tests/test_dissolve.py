"""Unions on carriers against exact fractions."""

import random
from fractions import Fraction

import numpy as np
import pytest

from skytrace.operators import dissolve, lines

SEGMENTS = "grp long, ax double, ay double, bx double, by double"


def line_of(a, b):
    """A name of the line through two points, by fractions."""
    (x1, y1), (x2, y2) = (tuple(map(Fraction, p)) for p in (a, b))
    if (x1, y1) == (x2, y2):
        return ("point", x1, y1)
    if x1 == x2:
        return ("upright", x1)
    slope = (y2 - y1) / (x2 - x1)
    return (slope, y1 - slope * x1)


def union(segments):
    """{(grp, a, b)}: overlapping segments of one line as one."""
    lines_of = {}
    for grp, a, b in segments:
        a, b = sorted((a, b))
        lines_of.setdefault((grp, line_of(a, b)), set()).add((a, b))
    out = set()
    for (grp, _), own in lines_of.items():
        pieces = []
        for a, b in sorted(own):
            if pieces and a < pieces[-1][1]:
                pieces[-1][1] = max(pieces[-1][1], b)
            elif not pieces or (a, b) != (pieces[-1][0], pieces[-1][1]):
                pieces.append([a, b])
        out |= {(grp, a, b) for a, b in map(tuple, pieces)}
    return out


def random_segments(rng, n):
    out = []
    slopes = [(1, 0), (0, 1), (1, 2), (-3, 1), (0.1, 0.7)]
    for _ in range(n):
        dx, dy = rng.choice(slopes)
        base = rng.choice([(0.0, 0.0), (5.0, 1.0), (1e7 / 3, 0.25)])
        s, t = rng.randrange(30), rng.randrange(30)
        a, b = ((base[0] + k * dx, base[1] + k * dy) for k in (s, t))
        out.append((rng.randrange(3), a, b))
    return out


@pytest.mark.parametrize("carrier_rows", [dissolve.CARRIER_ROWS, 3])
def test_union_equals_exact_fractions(spark, carrier_rows):
    rng = random.Random(carrier_rows)
    segments = random_segments(rng, 600)
    rows = [(g, *min(a, b), *max(a, b)) for g, a, b in segments]
    df = spark.createDataFrame(rows, SEGMENTS).repartition(5)
    got = dissolve.union_on_carriers(df, ["grp"], carrier_rows).collect()
    found = {(r.grp, (r.ax, r.ay), (r.bx, r.by)) for r in got}
    assert len(found) == len(got)
    assert found == union(segments)


def test_one_carrier_over_many_ranges(spark):
    """A long segment reaches over ranges that hold only what it covers."""
    rng = random.Random(2)
    segments = [(0, (float(k), 1.0), (k + rng.choice([0.5, 1.0, 1.5]), 1.0)) for k in range(400)]
    segments += [(0, (50.0, 1.0), (300.25, 1.0)), (1, (0.0, 0.0), (1.0, 1.0))]
    rows = [(g, *a, *b) for g, a, b in segments]
    df = spark.createDataFrame(rows, SEGMENTS).repartition(5)
    got = dissolve.union_on_carriers(df, ["grp"], 10).collect()
    assert {(r.grp, (r.ax, r.ay), (r.bx, r.by)) for r in got} == union(segments)


def test_partly_shared_segments_count_once(spark):
    shapes = {
        1: [(0, 0), (50, 0)],
        2: [(80, 0), (30, 0)],
        3: [(80, 0), (90, 0)],
        4: [(40, -5), (40, 5)],
    }
    rows = [
        (i, "E - W", k, float(x), float(y)) for i, vs in shapes.items() for k, (x, y) in enumerate(vs)
    ]
    df = spark.createDataFrame(rows, "row_id long, direction string, vertex_no long, x double, y double")
    groups = df.selectExpr("row_id", "direction", "1L AS grp").distinct()
    pieces = {(r.ax, r.bx) for r in lines.dissolved_segments(df, groups).collect()}
    assert pieces == {(0, 80), (80, 90), (40, 40)}  # the crossing line stays whole
    (row,) = lines.merged_lines(df, groups).collect()
    assert row.long_km == pytest.approx(0.1)
    assert row.cx == pytest.approx((80 * 40 + 10 * 85 + 10 * 40) / 100)


def test_carriers_are_exact():
    third = 1 / 3
    assert dissolve._carrier(0.0, 0.0, 3.0, 1.0) == dissolve._carrier(6.0, 2.0, 9.0, 3.0)
    assert dissolve._carrier(0.0, 0.0, 3.0, 1.0) != dissolve._carrier(1.0, third, 2.0, 2 * third)
    assert dissolve._carrier(5.0, 1.0, 5.0, 9.0) == dissolve._carrier(5.0, -7.0, 5.0, -9.0)
    assert dissolve._carrier(1e-300, 0.0, 1e300, 0.0) == dissolve._carrier(0.0, 0.0, 1.0, 0.0)
    assert dissolve._carrier(1.0, None, 2.0, 3.0) == dissolve._carrier(1.0, float("nan"), 2.0, 3.0)


def test_carriers_by_column_equal_those_by_row(monkeypatch):
    rng = np.random.default_rng(5)
    whole = rng.integers(-9, 9, (4, 2000)).astype(float)
    parts = [whole, whole / 8, rng.integers(-(2**29), 2**29, (4, 500)).astype(float)]
    odd = [rng.normal(0, 1e5, (4, 500)), rng.integers(-9, 9, (4, 500)) * 1e300]
    odd += [rng.choice([0.0, -0.0, 5e-324, np.nan, np.inf, 2.0**30, 0.5 + 2.0**30], (4, 500))]
    every = np.hstack(parts + odd)
    assert dissolve._carriers(every).to_pylist() == [dissolve._carrier(*r) for r in every.T.tolist()]
    monkeypatch.delattr(dissolve, "_carrier")  # whole numbers and eighths take no step row by row
    assert dissolve._carriers(np.hstack(parts)).null_count == 0
