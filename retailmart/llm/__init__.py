"""Training-data operators: WARC, tokenization, deduplication, mixing, chat, toxicity.

One module per operator, ``queries.py`` registers one query for each.  The package is
pickled by value, so tasks need no copy of it on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
