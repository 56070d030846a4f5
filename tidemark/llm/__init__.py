"""Operators of a training-data pipeline over text documents.

One module per operator; ``queries`` registers the thin ``opN_*`` queries over
the driver's tables. Nothing else in the library imports this subpackage.
"""
