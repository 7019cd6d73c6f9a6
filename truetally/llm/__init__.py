"""Operators for large-scale training-data pipelines.

Ten operators (see README, "Training-data operators"), each in its own module,
with the registered queries in ``queries.py``. Nothing else in the library
imports this subpackage.
"""
