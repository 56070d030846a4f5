"""tidemark: a Spark-native commerce analytics build.

Raw events, products and customers are cleaned into a typed silver layer,
summarised per customer and product, and reported in a gold layer. Every model
is a plain function from DataFrames to a DataFrame built from Spark SQL
expressions, joins, aggregates and windows, so Catalyst plans the whole chain.
"""

from tidemark.session import get_session, lake_root

__all__ = ["get_session", "lake_root"]
