"""Operators for preparing training data; nothing else in the library imports them.

Functions of this package that run in Python workers travel by value, so executors need numpy, pyarrow
and (for token counts) the tokenizer library, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
