"""Operators for preparing language-model training data.

One module per operator; ``registry`` lists the queries built on them. Nothing
outside this package imports it, except the driver entry point.
"""
