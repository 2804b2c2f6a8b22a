"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Each module holds one operator
(or a helper that several share); ``queries`` registers them.
"""
