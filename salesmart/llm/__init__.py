"""Training-data operators: document, vector and conversation operators, and the queries that apply them.

Nothing outside this package imports it.  Task code is pickled by value, so executors need
only the public libraries (numpy, pyarrow, xxhash, tokenizers), not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
