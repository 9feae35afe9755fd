"""Operators for large text collections (training-data preparation).

Every operator takes and returns DataFrames; ``queries`` holds the registered
queries over the driver tables. Nothing else in the library imports this
subpackage. Operators that run Python on executors send the package to them
(``common.ship``).
"""
