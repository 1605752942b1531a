"""SQL functions for ``spark.sql``: IsInNYC, ToCellId, ToCoords.

They are SQL-bodied temporary functions, so Catalyst inlines them like any
built-in expression (no Python in the plan).
"""

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "is_in_nyc": (
        "(lon FLOAT, lat FLOAT) RETURNS BOOLEAN RETURN "
        "NOT (lon > -73.7D OR lon < -74.05D) AND NOT (lat > 41.0D OR lat < 40.5D)"),
    "to_cell_id": (
        "(lon FLOAT, lat FLOAT) RETURNS INT RETURN "
        "try_cast(try_add(floor((74.05D - abs(lon)) / 0.0014D), "
        "try_multiply(250L, floor((41.0D - lat) / 0.00125D))) AS INT)"),
    "to_coords": (
        "(cell INT) RETURNS STRUCT<lon: FLOAT, lat: FLOAT> RETURN named_struct("
        "'lon', CAST(-(74.05D - (cell % 250) * 0.0014D - 0.0007D) AS FLOAT), "
        "'lat', CAST(41.0D - CAST((cell - cell % 250) / 250 AS BIGINT) * 0.00125D - 0.000625D AS FLOAT))"),
}

# Names of the original job's SQL functions, registered as aliases.
_ALIASES = {"IsInNYC": "is_in_nyc", "ToCellId": "to_cell_id", "ToCoords": "to_coords"}


def register_functions(spark: SparkSession) -> list[str]:
    names = []
    for name, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    for alias, name in _ALIASES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {alias}{_FUNCTIONS[name]}")
        names.append(alias)
    return names
