"""Operators that prepare text corpora for training.

Nothing else in the library imports this subpackage. Each module holds one
operator with an interface of its own; ``queries`` registers a thin query for
each, over the whole of its table.
"""
