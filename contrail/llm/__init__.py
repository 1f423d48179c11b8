"""Training-data operators: one module per operator, plus the registered queries.

Functions shipped to Python workers are pickled by value, so executors need
no copy of this package (they need numpy, pyarrow and, where an operator says
so, pyahocorasick or tokenizers).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
