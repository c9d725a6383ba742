"""Training-data operators: dedup, tokenization, mixing, search, scoring.

Nothing else in the library imports this subpackage. Functions that run in
executors' Python workers are shipped by value, so executors need only the
public packages (numpy, pandas, pyarrow, regex), not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
