"""quillwork: gather, pair, label, score and format rewrite examples as Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Batch functions travel to the executors with their code, so the package need
# only be on the driver's path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
