"""marketlens — local-market intelligence as Spark DataFrame plans.

Every public function takes DataFrames (or a SparkSession + data dir) and
returns a lazy DataFrame; nothing here collects data to the driver.
"""

from marketlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task, so a
# cluster needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
