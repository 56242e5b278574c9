"""Operators for preparing training text: one module each, over any DataFrame of texts.

Functions that run on executors are sent by value, so the package needs no installation there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
