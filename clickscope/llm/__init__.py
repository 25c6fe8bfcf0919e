"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; it only borrows the
library's shared-storage helper. ``queries`` holds the registered queries
and ``oracle`` their SQL.
"""
