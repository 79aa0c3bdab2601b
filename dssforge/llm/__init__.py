"""Operators for building training data from text corpora.

Nothing else in the package imports this subpackage.  Each operator is a
module with its own general interface; ``entries`` holds the registered
queries and their SQL.
"""
