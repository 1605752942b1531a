"""Ship modules whose functions run in Python workers by value (cloudpickle)."""

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
