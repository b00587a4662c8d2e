"""newsprep: prepare and judge supervised fine-tuning data as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python code that runs in tasks travels with them, so executors need only
# Python, pandas and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
