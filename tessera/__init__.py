"""tessera: Spark-native preparation, checking and measurement of language-model training data.

Everything is expressed with DataFrame / SQL operators; Arrow (pandas) functions are used only
where Spark has no native equivalent (NFKC normalisation and applying a merge table to a word).
"""

__version__ = "0.1.0"

# Ship this package's functions to Python workers by value, so executors need no install.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
