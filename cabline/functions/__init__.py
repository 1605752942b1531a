from cabline.functions.geo import (  # noqa: F401
    cell_center_lat, cell_center_lon, cell_x, cell_y, cells_on_way, direction, direction_bucket,
    distance, distance_to_point, in_nyc, to_cell, unpacked_run, walk_cells, walk_deltas, walk_runs,
    walk_runs_of,
)
from cabline.functions.labels import erraticness_label, iso_instant  # noqa: F401
from cabline.functions.sql import register_functions  # noqa: F401
