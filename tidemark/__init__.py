"""tidemark — behaviour-event analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions so that Catalyst can prune, push down and plan it.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
