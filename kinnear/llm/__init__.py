"""Operations of a training-data pipeline over ``documents`` (see README).

Python functions that run inside Spark tasks are pickled by value, so the
executors need the public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
