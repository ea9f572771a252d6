"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``pages``.

Every module holds one operator with a general interface; ``queries`` registers one
query for each and ``oracle`` the SQL where SQL can express it.  Functions that run in
Python workers are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
