"""Composed plans: the full medallion build, plan checks and the SQL oracle."""
