"""Operators of a training-data pipeline over document tables.

One module per operator; ``queries`` registers one query per operator and
``../../corpus_pipeline.py`` chains five of them.  Nothing else in the library
imports this package.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
