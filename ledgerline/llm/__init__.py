"""Training-data operators: deduplication, filtering, counting, mixing, encoding.

Each module holds one operator with its own general interface and the thin
registered query that derives the digest columns from it. Nothing outside this
package (but ``corpus_pipeline.py`` and the guarded lines of
``__spark_entry__.py``) imports it.

Functions that run in Python workers are pickled by value, so executors need
no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
