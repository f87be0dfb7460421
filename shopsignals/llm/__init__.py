"""Training-data operators: quality, toxicity, scoring, de-duplication, mixing, packing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  The
functions that run inside Python tasks are shipped by value, so executors need
neither this package on their path nor a copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
