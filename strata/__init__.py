"""Layered batch analytics on Spark: raw, trusted and KPI tables.

Every operator is a function from DataFrame to DataFrame (or Column to Column)
made of Spark built-ins; none starts a session, an action or a Python worker
unless its docstring says so.
"""
