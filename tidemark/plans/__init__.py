"""Composed pipelines (plans) and the query registry."""
