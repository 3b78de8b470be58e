"""Operators for training-data pipelines; nothing else in the library imports this subpackage."""


def shipped(name: str) -> None:
    """Send a module's functions to the tasks by value, so that executors need no copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[name])
