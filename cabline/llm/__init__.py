"""Training-data operators (README, "Training-data operators").

Nothing else in the library imports this subpackage.  Its functions run in
Python workers by value, so the workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
