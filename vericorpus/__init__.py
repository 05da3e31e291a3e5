"""vericorpus: set-oriented operators over corpora of contracts, specifications and verifier runs."""

import sys as _sys

try:  # functions shipped to Python workers travel by value, so executors need no copy of this package
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except ImportError:  # pragma: no cover - PySpark is there in every supported set-up
    pass

__version__ = "0.1.0"
