"""Golden tests of the geography rules."""

from pyspark.sql import functions as F

from cabline.functions import geo
from cabline.functions.labels import erraticness_label, iso_instant
from cabline.functions.sql import register_functions


def _one(spark, cols, schema, exprs):
    df = spark.createDataFrame([cols], schema)
    return df.select(*exprs).first()


def test_box_edges_float_semantics(spark):
    # float -73.7 and -74.05 widen to values just outside the double bounds
    rows = [(-73.7, 40.7, False), (-74.05, 40.7, False), (-73.8, 40.5, True),
            (-73.8, 41.0, True), (-73.8, 41.001, False), (0.0, 0.0, False),
            (float("nan"), 40.7, False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "lon float, lat float")
    got = [r[0] for r in df.select(geo.in_nyc("lon", "lat")).collect()]
    assert got == [e for _, _, e in rows]


def test_cell_of_cell_centre_is_the_cell(spark):
    cells = spark.range(0, 250 * 400, 97).select(F.col("id").cast("int").alias("cell"))
    back = cells.select("cell", geo.to_cell(geo.cell_center_lon("cell"),
                                            geo.cell_center_lat("cell")).alias("again"))
    assert back.where("cell <> again").count() == 0


def test_cell_numbers(spark):
    r = _one(spark, (-74.05 + 0.0007, 41.0 - 0.000625), "lon float, lat float",
             [geo.to_cell("lon", "lat"), geo.cell_center_lon(F.lit(251)),
              geo.cell_center_lat(F.lit(251))])
    assert r[0] == 0
    assert abs(r[1] - (-(74.05 - 0.0014 - 0.0007))) < 1e-5
    assert abs(r[2] - (41.0 - 0.00125 - 0.000625)) < 1e-5


def test_walk_golden_paths():
    (diag,) = geo.walk_cells([0], [0], [3], [3])
    assert [(c % 250, c // 250) for c in diag] == [(0, 0), (1, 1), (2, 2), (3, 3)]
    # descending branch: diagonal step followed by a second x step
    (desc,) = geo.walk_cells([0], [10], [3], [7])
    assert [(c % 250, c // 250 - 10) for c in desc] == [(0, 0), (2, -1), (2, -2), (4, -3)]


def test_walk_is_symmetric_in_end_order_and_bounded():
    import numpy as np
    rng = np.random.default_rng(1)
    x1, y1 = rng.integers(0, 250, 500), rng.integers(0, 400, 500)
    x2, y2 = rng.integers(0, 250, 500), rng.integers(0, 400, 500)
    a = geo.walk_cells(x1, y1, x2, y2)
    b = geo.walk_cells(x2, y2, x1, y1)
    for i in range(500):
        assert list(a[i]) == list(b[i]) or x1[i] == x2[i]
        assert len(a[i]) <= abs(x1[i] - x2[i]) + abs(y1[i] - y2[i]) + 2


def test_direction_and_bucket(spark):
    df = spark.createDataFrame([(-73.9, 40.7, -73.8, 40.7), (-73.9, 40.7, -73.9, 40.8),
                                (-73.9, 40.7, -74.0, 40.7)], "a float, b float, c float, d float")
    got = df.select(geo.direction("a", "b", "c", "d").alias("dir")) \
        .select("dir", geo.direction_bucket("dir").alias("b")).collect()
    # cos() gets degrees as radians: cos(40.7) < 0 flips east and west
    assert [r.dir for r in got] == [359, 269, 179]
    assert [r.b for r in got] == [7, 5, 3]
    buckets = spark.createDataFrame([(-1,), (0,), (44,), (45,), (359,)], "d int") \
        .select(geo.direction_bucket("d").alias("b")).collect()
    assert [r.b for r in buckets] == [0, 0, 0, 1, 7]


def test_distance_uses_degrees_as_radians(spark):
    import math
    r = _one(spark, (-73.9, 40.7, -73.8, 40.75), "a float, b float, c float, d float",
             [geo.distance("a", "b", "c", "d")])
    import numpy as np
    f = np.float32
    x = float(f(40.7) - f(40.75))
    y = float(f(-73.9) - f(-73.8)) * math.cos(float(f(40.75)))
    assert abs(r[0] - 110.25 * math.sqrt(x * x + y * y)) < 1e-9


def test_labels_and_iso(spark):
    df = spark.createDataFrame([(0.0,), (2.49,), (2.5,), (4.99,), (5.0,), (30.0,)], "e double")
    assert [r[0] for r in df.select(erraticness_label("e")).collect()] == \
        ["calm", "calm", "busy", "busy", "crazy", "crazy"]
    r = spark.sql("SELECT TIMESTAMP'2013-01-01 01:00:00' AS t").select(iso_instant("t")).first()
    assert r[0] == "2013-01-01T01:00:00Z"


def test_sql_functions(spark):
    register_functions(spark)
    r = spark.sql("SELECT IsInNYC(CAST(-73.8 AS FLOAT), CAST(40.7 AS FLOAT)) a, "
                  "is_in_nyc(CAST(-73.7 AS FLOAT), CAST(40.7 AS FLOAT)) b, "
                  "ToCellId(CAST(-74.0493 AS FLOAT), CAST(40.9994 AS FLOAT)) c, "
                  "ToCoords(251).lat d").first()
    assert (r.a, r.b, r.c) == (True, False, 0)
    assert abs(r.d - (41.0 - 0.00125 - 0.000625)) < 1e-5
    plan = spark.sql("SELECT is_in_nyc(CAST(-73.8 AS FLOAT), CAST(40.7 AS FLOAT))") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_walk_depends_only_on_the_offset():
    """Shifting a walk's start shifts every cell: walk = start cell + steps of its offset."""
    import numpy as np
    rng = np.random.default_rng(7)
    dx, dy = rng.integers(0, 250, 3000), rng.integers(-400, 401, 3000)
    sx, sy = rng.integers(0, 250, 3000), rng.integers(0, 401, 3000)
    absolute = geo.walk_cells(sx, sy, sx + dx, sy + dy)
    steps = geo.walk_deltas(dx, dy)
    for i in range(3000):
        assert list(absolute[i]) == list(steps[i] + sx[i] + geo.GRID_X * sy[i])
        assert len(steps[i]) <= dx[i] + abs(dy[i]) + 1


def test_runs_are_the_cells_of_their_walks():
    """Every cell of a walk is in one of its runs, once; runs are far fewer than cells."""
    import numpy as np

    from cabline.functions import geo
    rng = np.random.default_rng(3)
    dx = np.concatenate([[0, 0, 1, 3, 3, 249, 0, 249], rng.integers(0, 250, 800)])
    dy = np.concatenate([[0, 4, 0, 3, -3, 400, -400, 0], rng.integers(-400, 401, 800)])
    walks = geo.walk_deltas(dx, dy)
    walk, first, cells, stride = geo.walk_runs(walks)
    for i, expected in enumerate(walks):
        mine = np.flatnonzero(walk == i)
        found = np.concatenate([first[k] + stride[k] * np.arange(cells[k]) for k in mine])
        assert sorted(found.tolist()) == sorted(expected.tolist())
    assert (stride > 0).all() and 2.5 * len(walk) < sum(map(len, walks))
    assert cells.max() < 1 << geo._RUN_CELLS_BITS and stride.max() < 1 << geo._RUN_STRIDE_BITS
