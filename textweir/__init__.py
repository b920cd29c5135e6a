"""Text analytics and retrieval over Spark DataFrames.

Every operator is a function from DataFrame(s) to DataFrame. Term statistics stay in
long form (one row per document and term), so they grow with the cluster instead of
with one machine's memory.
"""

import sys

from pyspark import cloudpickle

# The few Arrow helpers travel to the workers by value, so a cluster needs no --py-files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
