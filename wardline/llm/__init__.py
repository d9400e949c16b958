"""Operators for preparing training text: one module per operator, plus their registered queries.

Nothing else in the library imports this subpackage.
"""
