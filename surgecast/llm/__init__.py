"""Operators for preparing language-model training data (see README).

One module per operator. Each has a general DataFrame function and a thin
``opN_...`` query; ``registry`` lists the queries and their SQL.
"""
