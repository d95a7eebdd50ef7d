import random

from skytrace.operators import coverage


def test_area_of_a_rectangle(spark):
    corners = [(0, 0), (100, 0), (100, 50), (0, 50), (0, 0)]
    rows = [(1, i, float(x), float(y)) for i, (x, y) in enumerate(corners)]
    rows += [(2, 0, 0.0, 0.0), (2, 1, 5.0, 5.0), (2, 2, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "project_id long, pos long, x double, y double")
    got = {r.project_id: (r.area_m2, r.area_ha, r.area_km2) for r in coverage.ring_areas(df).collect()}
    assert got == {1: (5000.0, 0.5, 0.005), 2: (None, None, None)}


def test_boxes_of_every_size(spark, monkeypatch):
    rng = random.Random(6)
    points = [(i, rng.randrange(-50, 50) / 2, rng.randrange(-50, 50) / 2) for i in range(2000)]
    boxes = []
    for side in (0, 0.5, 1, 3, 8, 30):
        for _ in range(3):
            x, y = rng.randrange(-40, 40) / 2, rng.randrange(-40, 40) / 2
            boxes.append((x, x + side, y, y + side * rng.choice([0.25, 1])))
    df = spark.createDataFrame(points, "point_id long, x double, y double")
    frame = spark.createDataFrame(boxes, "x_min double, x_max double, y_min double, y_max double")
    kept = coverage.exclude_boxes(df, frame)
    want = {
        i
        for i, x, y in points
        if not any(a <= x <= b and c <= y <= d for a, b, c, d in boxes)
    }
    assert {r.point_id for r in kept.collect()} == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange") == plan.count("BroadcastExchange")  # points stay where they are
    for limit in ("BROADCAST_BYTES", "FEW_SIZES"):
        monkeypatch.setattr(coverage, limit, -1)
        together = coverage.exclude_boxes(df, frame)
        assert {r.point_id for r in together.collect()} == want
        logical = together._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("Join LeftSemi") == 1  # boxes of all sizes together
        monkeypatch.undo()
    literal = df.filter(~coverage.in_any_box(df.x, df.y, boxes))
    assert {r.point_id for r in literal.collect()} == want


def test_boxes_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(coverage, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, float(i), 0.0) for i in range(100)], "point_id long, x double, y double")
    schema = "x_min double, x_max double, y_min double, y_max double"
    boxes = spark.createDataFrame([(10.0, 19.0, -1.0, 1.0), (50.0, 50.0, 0.0, 0.0)], schema)
    kept = {r.point_id for r in coverage.exclude_boxes(df, boxes).collect()}
    assert kept == set(range(100)) - set(range(10, 20)) - {50}
    none = spark.createDataFrame([], schema)
    assert coverage.exclude_boxes(df, none).count() == 100
