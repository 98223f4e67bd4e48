"""salesguard: sales-anomaly analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers, the canonical input views, sinks (CSV/parquet/upsert)
functions  column expressions (calendar buckets, rounding, Box-Cox, moments)
operators  datasets, detectors and attribution rules; DataFrame in, DataFrame out
plans      the three end-to-end flows and the query registry
streaming  Structured Streaming scorer (daily tumbling sales vs. range table)
"""

__all__ = ["session"]


def _ship_by_value() -> None:
    """Pickle this package's functions by value in Python UDF closures, so
    executors run them without having the package installed or on their path."""
    import sys

    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):
        pass


_ship_by_value()
