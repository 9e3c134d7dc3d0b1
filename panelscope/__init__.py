"""panelscope: representativeness analytics for payroll microdata panels on Spark.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects, is
parameterised by ``grouping_cols`` and is expressed with the DataFrame API so
that Catalyst plans it (pushdown, pruning, partial aggregation, AQE).
"""

__version__ = "0.1.0"

# Ship this package's functions to Python workers by value, so pandas UDFs run
# on executors that do not have the package installed.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
