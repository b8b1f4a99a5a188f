"""Operators for preparing training text: packing, language, personal data, duplicates, search.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value: they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
