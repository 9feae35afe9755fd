"""Fixed values and canonical schemas used by the operators.

Everything in this package is data: lists and dictionaries whose exact values
decide results (alias maps, code maps, keyword lists). Operators take them as
default arguments, so a user can pass their own.
"""
