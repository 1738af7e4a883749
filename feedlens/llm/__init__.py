"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; ``queries.py`` holds
its registered queries and their SQL, and ``corpus_pipeline.py`` at the
repository top chains five of the operators.
"""
