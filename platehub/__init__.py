"""platehub: manufacturing data-exchange jobs as Spark DataFrame plans."""

import sys as _sys

# The few functions that run in Python workers (the pick of an event's first
# call in a stream) are shipped by value, so executors need no installed copy of
# this package and no particular working directory.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
