"""transitlens: continuous analytics over vehicle position reports on Spark.

Reports are JSON documents (one per line) read from a landing directory as a
bounded table (``spark.read``) or as a stream (``spark.readStream``).  Every
question is a DataFrame transformation, so the same code serves both modes.
"""

import sys as _sys

try:
    # The few Python functions that run inside tasks (the trailing-list scan,
    # the keyed last-N state, foreachBatch writers) are shipped by value, so
    # executors need not have this package installed or on their path.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError):  # pragma: no cover - older cloudpickle
    pass

__all__ = ["schema", "session"]
