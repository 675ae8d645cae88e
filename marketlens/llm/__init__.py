"""Operators for preparing language-model training data.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which counts as
part of it) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task, so a
# cluster needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
