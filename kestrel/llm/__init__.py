"""Training-data operators: mixing, licence scans, HTML extraction, PII, decontamination,
near-duplicate and substring removal, quality rules and language identification.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.  Functions that run in
Python workers are shipped by value, so executors need Spark's Python and numpy but not this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
