"""Operators for training-data pipelines over the tables documents, labels and embeddings.

Nothing else in the library imports this subpackage. Each operator module has a general operator and
registers one thin query `opN_<name>` that applies it with production parameters to a whole table.
"""
