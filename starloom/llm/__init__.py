"""Operators for preparing training text: one module per operator, queries in ``queries``.

Each operator is a function from DataFrame to DataFrame and keeps all rows of
its input.  Nothing else in the package imports this subpackage.
"""
