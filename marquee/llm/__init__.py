"""Operators for building language-model training data.

One module per operator; ``queries`` registers a thin query for each over
the ``documents`` / ``labels`` / ``benchmark`` / ``conversations`` tables.
Nothing outside this package imports it.
"""
