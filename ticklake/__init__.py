"""ticklake: daily market data and news analytics as Spark DataFrame operators.

Every public operator is a plain ``DataFrame -> DataFrame`` (or
``Column -> Column``) function.  Only scalars (a newest date, a count)
and a few bounded lists reach the driver; the work is expressed with the DataFrame API so Catalyst can push filters and
projections into the Parquet scan and AQE can size shuffles at run time.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle the package's Python functions by value.

    Grouped-map steps (``applyInArrow`` / ``applyInPandas``) send their
    function to the executors; pickled by value, the function does not need
    ``ticklake`` to be importable there (a cluster where the package is only
    on the driver, or a driver started from another working directory).
    """
    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark always ships it
        return
    import sys
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
