"""Operators for large-scale training-data preparation.

Nothing outside this folder imports it. ``registry`` lists the queries and
their oracle SQL for the driver contract.
"""
