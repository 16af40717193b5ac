"""tracklake: vessel tracks, RDF assertions and stream monitoring on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Send our Arrow functions and state processors to the executors by value, so that a job needs no
# --py-files and a worker can run them without this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
