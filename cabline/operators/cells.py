"""Grid-cell aggregations: ride events per cell and hour, traffic along ride paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabline.functions.geo import (GRID_X, cell_center_lat, cell_center_lon, cell_x, cell_y,
                                   in_nyc, to_cell, unpacked_run, walk_runs_of)
from cabline.operators.rides import event_time


def rides_per_cell(rides: DataFrame, size: str = "1 hour") -> DataFrame:
    """Ride starts and ends per grid cell and window, with the cell centre."""
    lon = F.when(F.col("is_start"), F.col("start_lon")).otherwise(F.col("end_lon"))
    lat = F.when(F.col("is_start"), F.col("start_lat")).otherwise(F.col("end_lat"))
    r = rides.select(lon.alias("lon"), lat.alias("lat"), "is_start", event_time().alias("t"))
    r = r.where(in_nyc("lon", "lat"))
    agg = r.groupBy(to_cell("lon", "lat").alias("cell_id"), F.window("t", size).alias("w")) \
        .agg(F.sum(F.col("is_start").cast("long")).alias("starts"),
             F.sum((~F.col("is_start")).cast("long")).alias("ends"))
    return agg.select("cell_id", F.col("w.start").alias("hour"), "starts", "ends",
                      cell_center_lon("cell_id").alias("center_lon"),
                      cell_center_lat("cell_id").alias("center_lat"))


def cell_traffic(pairs: DataFrame) -> DataFrame:
    """Number of rides whose straight path crosses each cell.

    1. Rides become paths: start cell and offset (dx >= 0, ends swapped as
       the walk does), counted per path with map-side combine.
    2. The distinct offsets -- at most 250 x 801 inside the box, whatever the
       data size -- are walked once each, in Arrow batches, into runs: cells whose
       ids are one stride apart (a walk's rows, columns or diagonals).
    3. Paths join their offset's runs (sort-merge on the offset).  A path that
       crosses a run adds its weight where the run begins and takes it off one
       stride behind its end; these marks are summed map-side.
    4. Along each chain of cells one stride apart, a running sum of the marks
       is the weight of the cells up to the next mark.  From the marks on, rows are
       bounded by the grid times the strides that occur.
    """
    p = pairs.where(in_nyc("start_lon", "start_lat") & in_nyc("end_lon", "end_lat"))
    x1, y1 = cell_x("start_lon"), cell_y("start_lat")
    x2, y2 = cell_x("end_lon"), cell_y("end_lat")
    swap = x1 > x2
    sx, sy = F.when(swap, x2).otherwise(x1), F.when(swap, y2).otherwise(y1)
    paths = (p.select((sx + F.lit(GRID_X) * sy).cast("long").alias("start_cell"),
                      F.abs(x2 - x1).cast("long").alias("dx"),
                      F.when(swap, y1 - y2).otherwise(y2 - y1).cast("long").alias("dy"))
             .groupBy("start_cell", "dx", "dy").agg(F.count(F.lit(1)).alias("weight")))
    shapes = paths.select("dx", "dy").distinct()
    runs = shapes.select("dx", "dy", F.explode(walk_runs_of("dx", "dy")).alias("run"))
    # Never broadcast the runs: Spark's estimate of an exploded Python result
    # is far too small, and over the whole grid there are tens of millions.  A
    # sort-merge join on (dx, dy) is bounded per task by the grid (some hundred runs x
    # <= 100,000 start cells per offset).
    first, cells, stride = unpacked_run("run")
    crossed = paths.join(runs.hint("merge"), ["dx", "dy"]).select(
        (F.col("start_cell") + first).alias("at"), cells.alias("cells"), stride.alias("stride"),
        "weight")
    marks = crossed.select("stride", F.inline(F.array(
        F.struct("at", "weight"),
        F.struct((F.col("at") + F.col("cells") * F.col("stride")).alias("at"),
                 (-F.col("weight")).alias("weight"))))).groupBy("stride", "at").agg(
        F.sum("weight").alias("weight"))
    chain = Window.partitionBy("stride", F.pmod("at", F.col("stride"))).orderBy("at")
    spans = marks.select("stride", "at", F.sum("weight").over(chain).alias("weight"),
                         F.lead("at").over(chain).alias("until")).where("weight <> 0")
    crossed = spans.select("weight", F.explode(
        F.sequence("at", F.col("until") - F.col("stride"), "stride")).alias("cell_id"))
    return crossed.groupBy(F.col("cell_id").cast("int").alias("cell_id")).agg(
        F.sum("weight").alias("rides"))
