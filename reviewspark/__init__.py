"""reviewspark: Spark-native preparation, weighting and classification of labelled text."""

import sys as _sys

__version__ = "0.1.0"

# Python tasks (mapInPandas, pandas UDFs) carry functions defined in this
# package; pickling them by value means executors need no installed copy.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
