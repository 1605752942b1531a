"""Geography of the ride jobs as native Spark column expressions.

All functions take and return ``Column`` objects, so Catalyst inlines them into
whole-stage codegen; only the path walk (``cells_on_way``) needs Python, and it
runs vectorised over Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline._shipping import ship_by_value

# Code in this module runs inside Python workers: ship it with the task, so
# executors need no installed copy of the package.
ship_by_value(__name__)

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's constants for equal results):
# the NYC bounding box, the grid overlay and the length of one degree.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
GRID_X = 250
GRID_Y = 400
DEG_LEN = 110.25
DIRECTION_BUCKET_ANGLE = 45
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    """Double literal (coordinates stay float and are widened, as in the jobs)."""
    return F.lit(float(v)).cast("double")


def in_nyc(lon, lat) -> Column:
    """Inclusive box test; NaN coordinates count as outside (Spark orders NaN last)."""
    lon, lat = _c(lon), _c(lat)
    return (~((lon > _d(LON_EAST)) | (lon < _d(LON_WEST)))
            & ~((lat > _d(LAT_NORTH)) | (lat < _d(LAT_SOUTH))))


def cell_x(lon) -> Column:
    return F.floor((_d(abs(LON_WEST)) - F.abs(_c(lon))) / _d(DELTA_LON))


def cell_y(lat) -> Column:
    return F.floor((_d(LAT_NORTH) - _c(lat)) / _d(DELTA_LAT))


def to_cell(lon, lat) -> Column:
    """Grid cell id x + 250*y (no bounds check); null where the id leaves int range."""
    row = F.try_multiply(F.lit(GRID_X).cast("long"), cell_y(lat))
    return F.try_add(cell_x(lon), row).try_cast("int")


def cell_center_lon(cell) -> Column:
    x = _c(cell) % F.lit(GRID_X)
    return (-(_d(abs(LON_WEST)) - x * _d(DELTA_LON) - _d(DELTA_LON / 2))).cast("float")


def cell_center_lat(cell) -> Column:
    cell = _c(cell)
    y = ((cell - cell % F.lit(GRID_X)) / F.lit(GRID_X)).cast("long")
    return (_d(LAT_NORTH) - y * _d(DELTA_LAT) - _d(DELTA_LAT / 2)).cast("float")


def distance(lon1, lat1, lon2, lat2) -> Column:
    """Euclidean distance in km; differences are taken in float, cos gets degrees as radians."""
    lon1, lat1, lon2, lat2 = map(_c, (lon1, lat1, lon2, lat2))
    x = (lat1 - lat2).cast("double")
    y = (lon1 - lon2).cast("double") * F.cos(lat2.cast("double"))
    return _d(DEG_LEN) * F.sqrt(x * x + y * y)


def direction(start_lon, start_lat, dest_lon, dest_lat) -> Column:
    """Angle from start to destination, truncated toward zero, plus 179 (range -1..359).

    An angle that is no number counts as 0, as in the jobs; null stays null.
    """
    start_lon, start_lat, dest_lon, dest_lat = map(_c, (start_lon, start_lat, dest_lon, dest_lat))
    x = (dest_lat - start_lat).cast("double")
    y = (dest_lon - start_lon).cast("double") * F.cos(start_lat.cast("double"))
    return F.nanvl(F.degrees(F.atan2(x, y)), F.lit(0.0)).cast("int") + F.lit(179)


def direction_bucket(direction_col) -> Column:
    """Integer division by 45 (truncating, so -1 falls into bucket 0)."""
    return (_c(direction_col).cast("int") / F.lit(DIRECTION_BUCKET_ANGLE)).cast("int")


def distance_to_point(is_start, start_lon, start_lat, end_lon, end_lat, lon, lat) -> Column:
    """Distance from a point to the ride's own location (start for START, end for END)."""
    p_lon, p_lat = _c(lon).cast("float"), _c(lat).cast("float")
    return F.when(_c(is_start), distance(p_lon, p_lat, start_lon, start_lat)) \
        .otherwise(distance(p_lon, p_lat, end_lon, end_lat))


# ---------------------------------------------------------------------------
# Path walk (cells crossed by the straight line between two cells).


def walk_cells(x1, y1, x2, y2) -> list[np.ndarray]:
    """Walk all given cell pairs at once, one vectorised step per iteration.

    Follows the original step rule literally, including its descending branch
    where a diagonal step may be followed by a second x step.  Where that rule
    would step past the end row (the original never terminates there) the walk
    stops after that cell.
    """
    x1 = np.asarray(x1, dtype=np.int64)
    y1 = np.asarray(y1, dtype=np.int64)
    x2 = np.asarray(x2, dtype=np.int64)
    y2 = np.asarray(y2, dtype=np.int64)
    swap = x1 > x2
    sx = np.where(swap, x2, x1)
    sy = np.where(swap, y2, y1)
    ex = np.where(swap, x1, x2)
    ey = np.where(swap, y1, y2)
    slope = (ey - sy).astype(np.float64) / ((ex - sx).astype(np.float64) + 0.00000001)
    up = slope > 0
    cx = sx.copy()
    cy = sy.copy()
    n = len(sx)
    steps = [cx + cy * GRID_X]
    lengths = np.ones(n, dtype=np.int64)
    active = (cx < ex) | (cy != ey)
    while active.any():
        idx = np.nonzero(active)[0]
        ax, ay = cx[idx], cy[idx]
        a_up = up[idx]
        base = (ax - sx[idx]).astype(np.float64) + 0.5
        # ascending branch
        yu = base * slope[idx] + sy[idx] - 0.5
        diag_u = (yu > ay - 0.05) & (yu < ay + 0.05)
        nx_u = np.where(diag_u | (~diag_u & (yu < ay)), ax + 1, ax)
        ny_u = np.where(diag_u | (~diag_u & ~(yu < ay)), ay + 1, ay)
        # descending branch: diagonal step, then a second independent test
        yd = base * slope[idx] + sy[idx] + 0.5
        diag_d = (yd > ay - 0.05) & (yd < ay + 0.05)
        mx = np.where(diag_d, ax + 1, ax)
        my = np.where(diag_d, ay - 1, ay)
        right = yd > my
        nx_d = np.where(right, mx + 1, mx)
        ny_d = np.where(right, my, my - 1)
        nx = np.where(a_up, nx_u, nx_d)
        ny = np.where(a_up, ny_u, ny_d)
        cx[idx] = nx
        cy[idx] = ny
        step = np.full(n, np.iinfo(np.int64).min, dtype=np.int64)
        step[idx] = nx + ny * GRID_X
        steps.append(step)
        lengths[idx] += 1
        passed = np.where(up, cy > ey, cy < ey)
        active = ((cx < ex) | (cy != ey)) & ~passed
    mat = np.vstack(steps)
    return [mat[: lengths[i], i].astype(np.int32) for i in range(n)]


# Rows whose walks are computed together.
WALK_ROWS = 1024


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _cells_on_way_udf(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    ends = [s.to_numpy(dtype=np.float64, na_value=np.nan) for s in (x1, y1, x2, y2)]
    known = np.flatnonzero(~np.isnan(np.stack(ends)).any(0))
    out = np.full(len(x1), None, dtype=object)
    # blocks of rows: a block's walks are at most WALK_ROWS x the grid's longest walk
    for i in range(0, len(known), WALK_ROWS):
        part = known[i:i + WALK_ROWS]
        for row, cells in zip(part, walk_cells(*(e[part].astype(np.int64) for e in ends))):
            out[row] = cells
    return pd.Series(out)


def walk_deltas(dx, dy) -> list[np.ndarray]:
    """Cell-id steps ``ox + 250*oy`` of the walk from a cell to the cell (dx, dy) away, dx >= 0.

    The step rule only looks at offsets from the start, so the walk from
    (x, y) to (x+dx, y+dy) is the cells ``x + 250*y + delta`` (checked against
    the absolute walk over every offset of the grid).  Inside the NYC box
    there are at most 250 x 801 offsets, so walking each once bounds the
    Python work by the grid, not by the number of rides.
    """
    dx = np.asarray(dx, dtype=np.int64)
    dy = np.asarray(dy, dtype=np.int64)
    zero = np.zeros_like(dx)
    return walk_cells(zero, zero, dx, dy)


# Bits of a packed run: cells of a walk (at most 651) and the id step between two of them.
_RUN_CELLS_BITS, _RUN_STRIDE_BITS = 10, 12
_RUN_OFFSET = 1 << 24               # makes first cells (deltas) positive


def walk_runs(walks: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(walk, first, cells, stride) of runs that together are the walks' cells, each once: a run
    is ``first, first + stride, ...``, ids ascending.

    Neighbouring steps of equal size form a run of the cells they lead to; a lone step's cell
    (a corner) joins the next run, whose first step starts there, so a staircase has
    one run a stair.
    """
    lengths = np.array([len(w) for w in walks], np.int64)
    cells = np.concatenate(walks).astype(np.int64) if len(walks) else np.zeros(0, np.int64)
    walk = np.repeat(np.arange(len(walks)), lengths)
    step = np.diff(cells, prepend=0)
    opens = np.zeros(len(cells), bool)
    opens[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    step[opens] = 0                                     # no step leads to a walk's first cell
    starts = np.flatnonzero(opens | (step != np.roll(step, 1)))
    size = np.diff(np.append(starts, len(cells)))
    of, lone = walk[starts], size == 1
    # place within a streak of lone groups of one walk
    new = np.ones(len(starts), bool)
    new[1:] = (of[1:] != of[:-1]) | ~lone[1:] | ~lone[:-1]
    at = np.arange(len(starts))
    place = at - np.maximum.accumulate(np.where(new, at, 0))
    joins = lone & (place % 2 == 0) & (np.append(of[1:], -1) == of)
    more = np.append(False, joins[:-1]).astype(np.int64)
    kept = ~joins
    first, count = cells[starts - more], size + more
    stride = np.where(step[starts] == 0, 1, step[starts])
    first = np.where(stride < 0, first + (count - 1) * stride, first)
    return of[kept], first[kept], count[kept], np.abs(stride)[kept]


@F.pandas_udf(T.ArrayType(T.LongType()))
def _walk_runs_udf(dx: pd.Series, dy: pd.Series) -> pd.Series:
    if not len(dx):
        return pd.Series([], dtype=object)
    walk, first, cells, stride = walk_runs(walk_deltas(dx.to_numpy(), dy.to_numpy()))
    packed = ((first + _RUN_OFFSET) << (_RUN_CELLS_BITS + _RUN_STRIDE_BITS)
              | cells << _RUN_STRIDE_BITS | stride)
    return pd.Series(np.split(packed, np.searchsorted(walk, np.arange(1, len(dx)))))


def walk_runs_of(dx, dy) -> Column:
    """Runs of the walk over an offset (array<long>, see ``unpacked_run``), Arrow-batched."""
    return _walk_runs_udf(_c(dx), _c(dy))


def unpacked_run(run) -> tuple[Column, Column, Column]:
    """(first cell as a delta, cells, stride) of a packed run."""
    run = _c(run)
    return (F.shiftright(run, _RUN_CELLS_BITS + _RUN_STRIDE_BITS) - F.lit(_RUN_OFFSET),
            F.shiftright(run, _RUN_STRIDE_BITS).bitwiseAND(F.lit((1 << _RUN_CELLS_BITS) - 1)),
            run.bitwiseAND(F.lit((1 << _RUN_STRIDE_BITS) - 1)))


def cells_on_way(lon1, lat1, lon2, lat2) -> Column:
    """Cell ids on the way between two points (array<int>), Arrow-batched.

    Null where a point is outside the NYC box (an empty coordinate reads as 0.0,
    tens of thousands of cells away).
    """
    inside = in_nyc(lon1, lat1) & in_nyc(lon2, lat2)
    return _cells_on_way_udf(*(F.when(inside, c) for c in (cell_x(lon1), cell_y(lat1),
                                                           cell_x(lon2), cell_y(lat2))))
