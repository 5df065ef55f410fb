"""Operators for a training-data pipeline, one module each.

Nothing else in the library imports this subpackage; ``queries`` lists what
``__spark_entry__`` registers from it.
"""
