"""lakemart: layered (raw, cleaned, modelled) data products on Spark.

Every operator is a function from DataFrame(s) to a lazy DataFrame, so Catalyst
sees the whole plan. Packages:

* ``sources``   - raw files to VARIANT Bronze rows, yearly CSV sets, calendar, sinks
* ``functions`` - column expressions (parsing, padding, dates, codes, bins)
* ``operators`` - Silver cleaning, Gold star schema and weekly mart, features,
                  extract sampling, forecast, metrics and dashboard widgets
* ``plans``     - bindings of the operators to the benchmark tables and the
                  registry used by ``__spark_entry__``
* ``streaming`` - incremental Bronze ingest of newly landed files
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Python functions of this package that run in Spark tasks (grouped-map
    pandas functions) are shipped by value, so executors need no install."""
    try:
        import sys

        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - optional: without it the package must be installed on executors
        pass


_pickle_by_value()
