"""Operators for large text corpora used as training data.

Each module holds one operator with a general interface (column names and
parameters are arguments); ``queries`` binds them to the ``documents``,
``benchmark``, ``labels`` and ``conversations`` tables. Nothing else in the
library imports this subpackage.
"""
